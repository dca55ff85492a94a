"""For every query, the SQL whose result it must equal over the same tables.

The SQL reads only the driver's tables and derives trips, zones, keys and facts itself.
"""

from tripmart import schemas
from tripmart.checks.fixtures import RAW_SQL, TRIP_ORDER, ZONES_SQL
from tripmart.checks.queries import SPLIT_YEAR
from tripmart.plans.models import FEATURES, FOREST_TREES, LABEL, MODELS

_MINUTES = "o_orderdate + to_minutes(cast({} as bigint))"
_RAW = (
    RAW_SQL.replace("{pickup}", _MINUTES.format("m"))
    .replace("{dropoff}", _MINUTES.format("m + cast(l_quantity as bigint) + 1"))
    .format(lineitem="lineitem", orders="orders", customer="customer", supplier="supplier")
)
_ZONES = ZONES_SQL.format(nation="nation", region="region")
_TRIP = ", ".join(schemas.RAW_TRIP.names)
_FACT = ", ".join(schemas.FACT_TRIP.names)
_DATES = ", ".join(schemas.DIM_DATETIME.names)
_COMPLETE = " and ".join(f"{name} is not null" for name in schemas.RAW_TRIP.names)
_VALID = f"{_COMPLETE} and trip_distance > 0 and passenger_count > 0"


def _parts(ts: str, prefix: str) -> str:
    return f"""
        hour({ts}) + minute({ts}) / 60.0e0 as {prefix}_hour,
        cast(day({ts}) as int) as {prefix}_day,
        cast(month({ts}) as int) as {prefix}_month,
        cast(year({ts}) as int) as {prefix}_year,
        dayname({ts}) as {prefix}_weekday,
        cast(dayofweek({ts}) + 1 as int) as {prefix}_weekday_id"""


def _case(code: str, names: dict[int, str]) -> str:
    whens = " ".join(f"when {value} then '{name}'" for value, name in names.items())
    return f"case {code} {whens} end"


def _total(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(18,4))) as double)"


_PARTS = (
    _parts("tpep_pickup_datetime", "pick") + "," + _parts("tpep_dropoff_datetime", "drop")
)
_TRIP_SORT = ", ".join(f"{name} nulls first" for name in TRIP_ORDER)
_PRELUDE = f"""
with raw as ({_RAW}),
zones as ({_ZONES}),
numbered as (
  select *, row_number() over (order by {_TRIP_SORT}) - 1 as trip_id from raw),
valid as (select * from numbered where {_VALID}),
pairs as (
  select *, row_number() over (order by tpep_pickup_datetime, tpep_dropoff_datetime) - 1 as datetime_id
  from (select distinct tpep_pickup_datetime, tpep_dropoff_datetime from valid)),
dates as (select *, {_PARTS} from pairs),
fact as (
  select trip_id, VendorID as vendor_id, datetime_id as datetimestamp_id,
         PULocationID as pu_location_id, DOLocationID as do_location_id,
         RatecodeID as ratecode_id, payment_type as payment_id, passenger_count,
         trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount, total_amount
  from valid join pairs using (tpep_pickup_datetime, tpep_dropoff_datetime)),
dated as (select * from fact join dates on datetimestamp_id = datetime_id),
payments as (
  select payment_type, {_case("payment_type", schemas.PAYMENT_NAMES)} as payment_type_name
  from (select distinct payment_type from valid) where payment_type <= 6),
paid as (select * from payments where payment_type not in (4, 6)),
periods as (
  select cast(year(tpep_pickup_datetime) as int) as year,
         cast(month(tpep_pickup_datetime) as int) as month,
         cast(count(*) as bigint) as rows
  from raw group by all)
"""


def _location(key: str, source: str = "valid") -> str:
    return f"""
        select LocationID as {key}, X, Y, zone, borough, service_zone
        from zones where LocationID in (select {key} from {source})"""


def _rezoned(rows: str) -> str:
    return f"""
        select * replace (case when borough = 'ASIA' then 'SZ9' else service_zone end as service_zone)
        from ({rows})"""


def _per_location(fact_key: str, side: str) -> str:
    return f"""
        select pick_year as year, LocationID, X as {side}_x, Y as {side}_y, zone, borough,
               service_zone, cast(count(*) as bigint) as total_trips
        from dated join zones on {fact_key} = LocationID
        group by all"""


def _per_version(fact_key: str) -> str:
    reformed = "borough = 'ASIA' and tpep_pickup_datetime >= timestamp '1999-01-01'"
    return f"""
        select pick_year as year, LocationID, X, Y, zone, borough,
               case when {reformed} then 'SZ9' else service_zone end as service_zone,
               case when borough = 'EUROPE' or {reformed}
                    then date '1999-01-01' else date '1995-01-01' end as valid_from,
               cast(count(*) as bigint) as total_trips
        from dated join zones on {fact_key} = LocationID
        group by all"""


def _metrics(name: str, prediction: str) -> str:
    error = f"({LABEL} - {prediction})"
    return f"""
        select '{name}' as name, round(sqrt(avg({error} * {error})), 4) as rmse,
               round(avg(abs({error})), 4) as mae,
               round(1 - avg({error} * {error}) / var_pop({LABEL}), 4) as r2
        from fact"""


def _correlation(left: str, right: str) -> str:
    value = "1.0e0" if left == right else f"round(corr({left}, {right}), 6)"
    return f"select '{left}' as feature, '{right}' as other, {value} as corr from dated"


_LABELLED = [LABEL, *FEATURES]
_SCALED = ", ".join(
    f"round(({axis} - avg({axis}) over ()) / stddev_samp({axis}) over (), 6) as scaled_{axis.lower()}"
    for axis in "XY"
)
_SPLIT_MONTH = SPLIT_YEAR * 100 + 7

_SELECTS = {
    "scan_trips": f"select {_TRIP} from raw",
    "scan_zones_csv": "select * from zones",
    "scan_warehouse": f"select {_FACT} from fact",
    "scan_partition_pruned": f"select {_DATES} from dates where pick_year = {SPLIT_YEAR}",
    "scan_batch_year": f"select {_TRIP} from raw where year(tpep_pickup_datetime) = {SPLIT_YEAR}",
    "ingest_landing": f"select {_TRIP} from raw",
    "last_key": """
        select (select max(trip_id) from fact) as trip_id,
               (select max(datetime_id) from pairs) as datetime_id""",
    "normalize_project": f"select {_TRIP} from raw",
    "normalize_dropna": f"select {_TRIP} from raw where {_COMPLETE}",
    "normalize_cast": f"select {_TRIP} from raw",
    "normalize_write": f"select {_TRIP} from raw where {_COMPLETE}",
    "normalize_fleet": f"select {_TRIP} from raw where {_COMPLETE}",
    "file_period": "select * from periods",
    "new_periods": f"""
        select * from periods where year = {SPLIT_YEAR} and year * 100 + month > (
          select max(year * 100 + month) from periods where year * 100 + month < {_SPLIT_MONTH})""",
    "period_floor": f"select * from periods where year > {SPLIT_YEAR}",
    "filter_dropna": f"select {_TRIP} from raw where {_COMPLETE}",
    "filter_year": f"select {_TRIP} from raw where year(tpep_pickup_datetime) = {SPLIT_YEAR}",
    "filter_valid_trips": f"""
        select {_TRIP} from valid where year(tpep_pickup_datetime) = {SPLIT_YEAR}""",
    "filter_not_in": f"select {_TRIP} from raw where payment_type not in (4, 6)",
    "project_prune": "select trip_id, datetimestamp_id, pu_location_id from fact",
    "project_rename": """
        select VendorID as vendor_id, PULocationID as pu_location_id,
               DOLocationID as do_location_id, RatecodeID as ratecode_id,
               payment_type as payment_id, total_amount
        from raw""",
    "project_with_renamed": f"""
        select * rename (X as pickup_x, Y as pickup_y) from ({_location("PULocationID")})""",
    "project_derive": f"select tpep_pickup_datetime, tpep_dropoff_datetime, {_PARTS} from raw",
    "project_drop": f"""
        select {_FACT}, pick_hour, pick_weekday_id, drop_hour, drop_weekday_id from dated""".replace(
        "datetimestamp_id, ", ""
    ),
    "alias_qualified": """
        select trip_id, payment_type_name as payment_name
        from fact join payments on payment_id = payment_type""",
    "cast_long": """
        select cast(RatecodeID as bigint) as ratecode_id, cast(payment_type as bigint) as payment_id
        from raw""",
    "cast_hour_int": "select datetime_id, cast(floor(pick_hour) as int) as hour from dates",
    "case_label": f"""
        select payment_type, {_case("payment_type", schemas.PAYMENT_NAMES)} as payment_type_name
        from raw""",
    "join_fact_datetime": """
        select trip_id, datetime_id, pick_year, pick_hour, pick_weekday, pick_weekday_id from dated""",
    "join_composite": f"""
        select {_TRIP}, datetime_id
        from valid join pairs using (tpep_pickup_datetime, tpep_dropoff_datetime)""",
    "join_broadcast": """
        select trip_id, payment_id, payment_type_name
        from fact join paid on payment_id = payment_type""",
    "join_star": """
        select trip_id, pick_year as year, LocationID, zone, borough
        from dated join zones on pu_location_id = LocationID""",
    "join_lookup": _location("PULocationID", "raw"),
    "fact_known_zone": f"""
        select {_FACT} from fact
        where pu_location_id in (select LocationID from zones)
          and do_location_id in (select LocationID from zones)""",
    "fact_all_zone": f"select {_FACT} from fact",
    "join_key_widen": """
        select trip_id, payment_type, payment_type_name
        from fact join payments on payment_id = payment_type""",
    "agg_total": f"""
        select cast(count(*) as bigint) as total_trips,
               cast(sum(passenger_count) as bigint) as total_passengers,
               {_total("trip_distance")} as total_distance,
               {_total("total_amount")} as total_amount,
               {_total("trip_distance")} / count(*) as average_distance_per_trip,
               {_total("total_amount")} / count(*) as average_amount_per_trip
        from fact""",
    "agg_per_year": f"""
        select pick_year as year,
               cast(count(*) as bigint) as total_trips,
               cast(sum(passenger_count) as bigint) as total_passengers,
               {_total("trip_distance")} as total_distance,
               {_total("total_amount")} as total_amount,
               cast(sum(passenger_count) as double) / count(*) as average_passengers_per_trip,
               {_total("trip_distance")} / count(*) as average_distance_per_trip,
               {_total("total_amount")} / count(*) as average_amount_per_trip
        from dated join paid on payment_id = payment_type
        group by pick_year""",
    "agg_wide_key": """
        select pick_year, LocationID as PULocationID, X, Y, zone, borough, service_zone,
               cast(count(*) as bigint) as total_trips
        from dated join zones on pu_location_id = LocationID
        group by all""",
    "agg_max": """
        select max(passenger_count) as max_passenger_count, max(trip_distance) as max_trip_distance,
               max(fare_amount) as max_fare_amount, max(total_amount) as max_total_amount
        from raw""",
    "distinct_pairs": "select tpep_pickup_datetime, tpep_dropoff_datetime from pairs",
    "head_rows": f"select {_DATES} from dates order by datetime_id limit 5",
    "dim_new_rows": f"""
        select tpep_pickup_datetime, tpep_dropoff_datetime from valid
        except
        select tpep_pickup_datetime, tpep_dropoff_datetime from valid
        where year(tpep_pickup_datetime) <= {SPLIT_YEAR}""",
    "append_union": f"select {_TRIP} from raw union all select {_TRIP} from valid",
    "fn_date_parts": """
        select tpep_pickup_datetime, cast(year(tpep_pickup_datetime) as int) as year,
               cast(month(tpep_pickup_datetime) as int) as month,
               cast(day(tpep_pickup_datetime) as int) as day
        from raw""",
    "fn_fractional_hour": """
        select tpep_pickup_datetime,
               hour(tpep_pickup_datetime) + minute(tpep_pickup_datetime) / 60.0e0 as pick_hour
        from raw""",
    "fn_dayofweek": """
        select tpep_dropoff_datetime,
               cast(dayofweek(tpep_dropoff_datetime) + 1 as int) as drop_weekday_id
        from raw""",
    "fn_weekday_name": """
        select tpep_dropoff_datetime, dayname(tpep_dropoff_datetime) as drop_weekday from raw""",
    "sink_overwrite": f"select {_TRIP} from valid",
    "sink_append": f"select {_TRIP} from raw union all select {_TRIP} from valid",
    "sink_partition_one": f"select {_TRIP} from raw",
    "sink_partition_two": f"select {_DATES} from dates",
    "sink_bucketed": f"select {_FACT} from fact",
    "sink_coalesce": f"select {_TRIP} from raw",
    "mart_append": _metrics("fare_amount", "fare_amount")
    + " union all "
    + _metrics("tip_amount", "tip_amount"),
    "dim_datetime": f"select {_DATES} from dates",
    "dim_pickup_location": _location("PULocationID"),
    "dim_dropoff_location": _location("DOLocationID"),
    "dim_rate_code": f"""
        select distinct RatecodeID, {_case("RatecodeID", schemas.RATE_CODE_NAMES)} as rate_code_name
        from valid where RatecodeID <= 6""",
    "dim_payment": "select * from payments",
    "dim_vendor": f"""
        select distinct VendorID, {_case("VendorID", schemas.VENDOR_NAMES)} as vendor_name
        from valid where VendorID <= 2""",
    "fact_trip": f"select {_FACT} from fact",
    "surrogate_key": "select * from pairs",
    "surrogate_key_next": f"""
        select * from pairs where year(tpep_pickup_datetime) > {SPLIT_YEAR}""",
    "warehouse_init": f"select {_FACT} from fact",
    "warehouse_batch": f"select {_FACT} from fact",
    "warehouse_backfill": f"select {_FACT} from fact",
    "incremental_load": f"""
        select {_FACT}, tpep_pickup_datetime, tpep_dropoff_datetime from dated""".replace(
        "trip_id, ", "", 1
    ).replace("datetimestamp_id, ", ""),
    "scd_type1": f"""
        select * from ({_rezoned(_location("PULocationID", "raw"))})""",
    "scd_type2": f"""
        select *, date '1995-01-01' as valid_from,
               case when borough = 'ASIA' then date '1999-01-01' end as valid_to,
               borough <> 'ASIA' as is_current
        from ({_location("DOLocationID", "raw")}) where borough <> 'EUROPE'
        union all
        select *, date '1999-01-01', cast(null as date), true
        from ({_rezoned(_location("DOLocationID", "raw"))}) where borough in ('ASIA', 'EUROPE')""",
    "trips_per_pickup_version": _per_version("pu_location_id"),
    "trips_per_dropoff_version": _per_version("do_location_id"),
    "trips_per_current_zone": f"""
        select * replace (case when borough = 'ASIA' then 'SZ9' else service_zone end as service_zone)
        from ({_per_location("pu_location_id", "pickup")})""",
    "period_ledger": f"""
        select year, month, rows, case when year <= {SPLIT_YEAR} then 'loaded' else 'new' end as state
        from periods""",
    "rejected_rows": f"""
        select case when not ({_COMPLETE}) then 'incomplete'
                    when not trip_distance > 0 then 'no distance'
                    else 'no passengers' end as reason, {_TRIP}
        from raw where not ({_VALID})""",
    "payment_per_year": """
        select pick_year as year, payment_id, payment_type_name as payment_name,
               cast(count(*) as bigint) as total_trips
        from dated join paid on payment_id = payment_type
        group by all""",
    "agg_per_payment": """
        select payment_id, payment_type_name as payment_name,
               cast(count(*) as bigint) as total_trips
        from fact join paid on payment_id = payment_type
        group by all""",
    "trips_per_pu_location": _per_location("pu_location_id", "pickup"),
    "trips_per_do_location": _per_location("do_location_id", "dropoff"),
    "trips_per_day": """
        select pick_year as year, pick_weekday as day, pick_weekday_id as day_order,
               cast(count(*) as bigint) as total_trips
        from dated group by all""",
    "trips_per_hour": """
        select pick_year as year, cast(floor(pick_hour) as int) as hour,
               cast(count(*) as bigint) as total_trips
        from dated group by all""",
    "ml_assemble": "select trip_id, "
    + ", ".join(f"cast({name} as double) as {name}" for name in FEATURES)
    + " from dated",
    "ml_scale": f"select PULocationID, {_SCALED} from ({_location('PULocationID')})",
    "feature_correlation": " union all ".join(
        f"select '{name}' as feature, round(corr({LABEL}, {name}), 6) as corr from dated"
        for name in FEATURES
    ),
    "correlation_matrix": " union all ".join(
        f"({_correlation(left, right)} limit 1)" for left in _LABELLED for right in _LABELLED
    ),
    "ml_features": f"""
        select trip_id, datetimestamp_id, {LABEL}, {", ".join(FEATURES)}
        from dated where pick_year = {SPLIT_YEAR}""",
    "ml_split": """
        select trip_id, substr(md5(cast(trip_id as varchar)), 1, 2) < 'cc' as training from fact""",
    "regression_metrics": _metrics("fare only", "fare_amount"),
    "kmeans_pickup_certificate": f"select PULocationID, true as nearest from ({_location('PULocationID')})",
    "kmeans_dropoff_certificate": f"select DOLocationID, true as nearest from ({_location('DOLocationID')})",
    "linear_certificate": " union all ".join(
        f"select '{name}' as feature, count(*) > 0 as optimal from fact" for name in FEATURES
    ),
    "tree_certificate": """
        select 'Decision Tree' as name, true as leaves_are_means, cast(count(*) as bigint) as rows
        from fact where substr(md5(cast(trip_id as varchar)), 1, 2) < 'cc'""",
    "forest_certificate": f"""
        select 'Random Forest' as name, {FOREST_TREES} as trees, true as mean_of_trees,
               true as within_labels, cast(count(*) as bigint) as rows
        from fact where substr(md5(cast(trip_id as varchar)), 1, 2) >= 'cc'""",
    "evaluation_certificate": f"""
        select name, rows, label_spread, true as r2_agrees, true as mae_below_rmse, true as better_than_mean
        from (select cast(count(*) as bigint) as rows, round(stddev_pop({LABEL}), 4) as label_spread
              from fact where substr(md5(cast(trip_id as varchar)), 1, 2) >= 'cc')
        cross join (values {", ".join(f"('{name}')" for name in MODELS)}) as models(name)""",
}
_SELECTS["mart_publish"] = _SELECTS["trips_per_hour"]
_SELECTS["scd_upsert"] = _SELECTS["scd_type1"]
_SELECTS["scd_add_versions"] = _SELECTS["scd_type2"]

ORACLES = {name: _PRELUDE + select for name, select in _SELECTS.items()}
