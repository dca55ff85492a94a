import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tripmart.checks.fixtures import YEAR_FOLDER, land  # noqa: E402
from tripmart.checks.queries import stored_warehouse  # noqa: E402
from tripmart.sources.trips import batch_path, read_trips, read_zones, with_source_row  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def landed(spark):
    return land(spark, SF_DIR)


@pytest.fixture(scope="session")
def raw(spark, landed):
    return with_source_row(read_trips(spark, landed.area))


@pytest.fixture(scope="session")
def zones(spark, landed):
    return read_zones(spark, landed.zones)


@pytest.fixture(scope="session")
def raw_year(spark, landed):
    def read(first, last=None):
        years = range(first, (last or first) + 1)
        paths = [batch_path(landed.area, year, YEAR_FOLDER) for year in years]
        return with_source_row(read_trips(spark, *paths))

    return read


@pytest.fixture(scope="session")
def warehouse(spark):
    return stored_warehouse(spark, SF_DIR)


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame in a fixed order, columns by name."""

    def sort(df):
        table = df.select(*sorted(df.columns)).collect()
        return sorted((tuple(row) for row in table), key=repr)

    return sort


@pytest.fixture(scope="session")
def plan():
    """Physical plan of a frame after it has run, as adaptive execution left it."""

    def text(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
