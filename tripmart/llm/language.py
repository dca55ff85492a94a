"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the bag of the character 1- to 4-grams inside its words, word ends included, each
hashed to a row of an embedding table. The mean of the rows goes through a linear softmax.
Both are trained by stochastic gradient descent in numpy on a bounded sample. Models of four
fifths of the sample each score the fifth left out; these scores fit the temperature and the
score below which a prediction is rejected.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import released, with_field

UNKNOWN = "und"
GRAMS = (1, 2, 3, 4)
# Rows of the table: as many as a 16-bit hash tells apart.
ROWS = 1 << 16
WIDTH = 16
# The sample: this many documents for each language, and so many in all.
DOCS_PER_LANGUAGE = 1_000
MAX_SAMPLE = 6_000
# Longer documents are left out of the sample, so that its size in bytes is bounded too.
MAX_SAMPLE_CHARS = 20_000
EPOCHS = 8
RATE = 0.5
# Small samples are gone through more often, until so many steps are made.
LEAST_STEPS = 16_000
# The sample is parted by so many; each part is scored by a model of the others.
FOLDS = 5
# A prediction is rejected when its score is below that of all but this share of the correctly
# labelled documents, when others scored them.
REJECTED = 0.002
# A sample of fewer documents says nothing of scores, and only ``und`` is rejected.
LEAST_CALIBRATED = 20
# Code points of a text handled at once.
SPAN = 1 << 18

_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def grams(text: str) -> Iterator[np.ndarray]:
    """Table rows of the n-grams of a whole text, in pieces of bounded size.

    Runs of anything but letters count as one word end each.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for start in range(0, len(points), SPAN):
        part = points[start : start + SPAN + max(GRAMS) - 1]
        ascii_letter = (part >= 97) & (part <= 122)
        letter = ascii_letter | (part >= 192) & (part != 215) & (part != 247)
        letter &= (part < 0x2000) | (part > 0x2BFF)
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] = True
        units = np.where(letter, part, np.uint32(32))[keep]
        inside = units != 32
        own = min(SPAN, len(part))
        limit = int(keep[:own].sum())
        rolled = np.zeros(len(units), np.uint32)
        clear = np.ones(len(units), bool)
        for size in range(1, max(GRAMS) + 1):
            count = len(units) - size + 1
            if count <= 0:
                break
            rolled = rolled[:count] * np.uint32(0x01000193) + units[size - 1 :] * _FACTORS[size - 1]
            if size > 2:
                clear = clear[:count] & inside[size - 2 : size - 2 + count]
            else:
                clear = clear[:count]
            if size not in GRAMS:
                continue
            mixed = rolled ^ (rolled >> np.uint32(15))
            mixed = (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(16)
            taken = clear if size > 1 else inside[:count]
            yield mixed[:limit][taken[:limit]].astype(np.int32)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table rows of a text and their share of all."""
    counts = np.zeros(ROWS, np.int64)
    for rows in grams(text):
        counts += np.bincount(rows, minlength=ROWS)
    rows = np.flatnonzero(counts)
    total = counts[rows].sum()
    return rows.astype(np.int32), (counts[rows] / max(1, total)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """``table`` holds for each n-gram row what it adds to each language's logit.

    Rows that no document had are zero.
    """

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, text: str) -> tuple[np.ndarray, float]:
        """The logits of a text, and the share of its n-grams that were learned."""
        total, count, learned = np.zeros(len(self.languages)), 0, 0
        for rows in grams(text):
            used = np.bincount(rows, minlength=ROWS) if len(rows) > ROWS else None
            if used is None:
                total += self.table[rows].sum(axis=0)
                learned += int(self.learned[rows].sum())
            else:
                total += used @ self.table
                learned += int(used[self.learned].sum())
            count += len(rows)
        return total / max(1, count) + self.bias, learned / max(1, count)

    @cached_property
    def learned(self) -> np.ndarray:
        return self.table.any(axis=1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated score, and whether the prediction is accepted.

        The score is the chance of the language, times the share of n-grams that were learned.
        A null text, one without a letter, and any text when nothing was learned are
        ``und`` with score 0 and not accepted.
        """
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        logits, learned = self.logits(text)
        chances = softmax(logits / self.temperature)
        best = int(chances.argmax())
        score = float(chances[best]) * learned
        return self.languages[best], score, score >= self.threshold


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def _fitted(
    bags: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, places: np.ndarray, width: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Table and bias for ``width`` languages, learned from the bags at ``places``."""
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / WIDTH, 1 / WIDTH, (ROWS, WIDTH)).astype(np.float32)
    weights = np.zeros((WIDTH, width), np.float32)
    bias = np.zeros(width, np.float32)
    learned = np.zeros(ROWS, bool)
    epochs = max(EPOCHS, -(-LEAST_STEPS // len(places)))
    steps, step = epochs * len(places), 0
    for _ in range(epochs):
        for place in random.permutation(places):
            rows, shares = bags[place]
            rate = RATE * (1 - step / steps)
            step += 1
            if not len(rows):
                continue
            learned[rows] = True
            mean = shares @ table[rows]
            error = -softmax(mean @ weights + bias)
            error[target[place]] += 1
            # the gradient of a mean is spread over its rows; scaled up as they are many
            inner = weights @ error
            weights += rate * np.outer(mean, error)
            bias += 0.1 * rate * error
            table[rows] += (rate * 20) * shares[:, None] * inner
    return np.where(learned[:, None], table @ weights, 0), bias


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], seed: int = 7) -> Model:
    """Fit a model on bags of n-grams, calibrated by models that leave out a part each."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((ROWS, 0)), np.zeros(0), 1.0, 0.0)
    index = {language: place for place, language in enumerate(languages)}
    target = np.array([index[label] for label in labels])
    every = np.arange(len(bags))
    flat, bias = _fitted(bags, target, every, len(languages), seed)
    if len(bags) < LEAST_CALIBRATED:
        return Model(languages, flat, bias, 1.0, 0.0)
    order = np.random.default_rng(seed).permutation(len(bags))
    logits, learned = np.zeros((len(bags), len(languages))), np.zeros(len(bags))
    for fold in range(FOLDS):
        own = order[fold::FOLDS]
        part, part_bias = _fitted(bags, target, np.setdiff1d(every, own), len(languages), seed)
        known = part.any(axis=1)
        for place in own:
            rows, shares = bags[place]
            logits[place] = shares @ part[rows] + part_bias
            learned[place] = shares @ known[rows]

    def loss(temperature: float) -> float:
        chances = softmax(logits / temperature)[every, target]
        return float(-np.log(np.maximum(chances, 1e-12)).mean())

    temperature = min(np.geomspace(0.05, 20, 61), key=loss)
    chances = softmax(logits / temperature)
    right = chances.argmax(axis=1) == target
    scores = chances.max(axis=1) * learned
    threshold = np.quantile(scores[right], REJECTED, method="lower") if right.any() else 0.0
    return Model(languages, flat, bias, float(temperature), float(threshold))


def sample(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, text) of the documents a model learns from.

    It takes DOCS_PER_LANGUAGE of each language by a hash of the text, or an equal share of that
    where they are more than MAX_SAMPLE in all, from whole documents of at most
    MAX_SAMPLE_CHARS; equal texts are sampled together.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    known = known.filter(F.length("text") <= MAX_SAMPLE_CHARS)
    languages = known.groupBy("lang").agg(F.count("*").alias("n"))
    # Past MAX_SAMPLE languages only the commonest are learned.
    top = languages.orderBy(F.desc("n"), "lang").limit(MAX_SAMPLE).withColumn(
        "share", F.least(F.lit(1.0), F.lit(float(DOCS_PER_LANGUAGE)) / F.col("n"))
    )
    mark = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    found = known.join(F.broadcast(top.drop("n")), "lang").withColumn("mark", mark)
    # by the rank inside a language, so that past MAX_SAMPLE all languages shrink alike
    found = found.filter("mark < share").withColumn("mark", F.col("mark") / F.col("share"))
    return found.orderBy("mark", "lang", "text").limit(MAX_SAMPLE).select("lang", "text")


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Train on a sample of the documents that have a text and a language.

    One task counts the bags of the sample and trains; the driver gets the model.
    Documents without a letter are not learned from.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [
            (label, *bag(value))
            for batch in batches
            for label, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        ]
        # The order in which rows arrive must not matter.
        used = sorted((own for own in found if len(own[1])), key=lambda own: (own[0], own[1].tobytes()))
        model = train([own[1:] for own in used], [own[0] for own in used])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([model.languages], pa.list_(pa.string())),
                pa.array([model.table.astype(np.float64).tobytes()], pa.binary()),
                pa.array([model.bias.astype(np.float64).tobytes()], pa.binary()),
                pa.array([model.temperature], pa.float64()),
                pa.array([model.threshold], pa.float64()),
            ],
            names=["languages", "table", "bias", "temperature", "threshold"],
        )

    # one task learns, so that neither the sample nor its bags reach the driver
    learned = sample(docs, text, lang).coalesce(1).mapInArrow(
        released(learn), "languages array<string>, table binary, bias binary, temperature double, threshold double"
    )
    row = learned.first()
    if row is None:  # no partition at all
        return train([], [])
    table = np.frombuffer(row["table"]).reshape(ROWS, len(row["languages"]))
    bias = np.frombuffer(row["bias"])
    return Model(list(row["languages"]), table, bias, row["temperature"], row["threshold"])


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    names: tuple[str, str, str] = ("lang_pred", "score", "accepted"),
) -> DataFrame:
    """All rows and columns, then the language of the whole text, its score, and acceptance.

    Columns that the input has of the three names are replaced. Rows are independent, so
    repeated rows get equal answers. The model has a fixed number of rows for each
    language, so it is broadcast.
    """
    rows = docs.drop(*names)
    parts = (model.languages, model.table, model.bias, model.temperature, model.threshold)
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    place = rows.columns.index(text)
    schema = with_field(rows.schema, (names[0], "string"), (names[1], "double"), (names[2], "boolean"))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for batch in batches:
            found = [known.predict(value.as_py()) for value in batch.column(place)]
            more = list(zip(*found)) if found else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(more[0], pa.string()),
                    pa.array(more[1], pa.float64()),
                    pa.array(more[2], pa.bool_()),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(released(tasks), schema)
