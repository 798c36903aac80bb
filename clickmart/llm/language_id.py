"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is its letters, lower-cased, in words; its subwords are the runs of two to four bytes with the marks of
word ends. Each subword has a row in an embedding table by hash; the mean of the rows goes through a linear
layer into a softmax. Both are trained together by stochastic gradient descent in numpy on a bounded sample,
whose features the cluster computes. Another part of the sample calibrates the confidence and the rejection. The
least confidence goes by the length of a text: runs of many lengths of the calibrating texts are held against the
same runs with their letters shuffled, and against texts of a label that a model did not learn.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.arrays import LOWER, pieces, utf8

BUCKET_BITS = 14
SIZES = (2, 3, 4)
DIMENSIONS = 16
SAMPLE_ROWS = 2000  # labelled texts to learn from, in all
MOST_PER_LABEL = 500
FREQUENT_LABELS = 10_000
EPOCHS = 10
RATE = 0.3
DECAY = 0.1  # of the embeddings after each epoch
WRONGLY_REJECTED = 0.001  # of the calibration texts that are predicted right
MOST_WRONGLY_REJECTED = 0.01  # of them, where a higher limit keeps enough foreign texts out
KEEP_WEIGHT = 10  # foreign texts that may stay for a right one that goes
LENGTHS = (16, 64, 256)  # subwords of a text from which the next limit holds
OTHER_LENGTH = 0.001  # what a row counts for the limit of the next length
FEW_ROWS = 10  # a limit that rests on so many rows is half of what they say
LEFT_OUT_PARTS = 4  # parts of the labels that are left out in turn
LEFT_OUT_EVERY = 3  # a model without a part learns from each third text
LONGEST_RUN = 512  # words of the calibrating runs
ROLES = TRAIN, CALIBRATE, NOISE = 0, 1, 2
UNKNOWN = "und"

# Letters stay, also those beyond ASCII by their bytes; everything else counts as a space.
PLAIN = np.full(256, 32, np.uint8)
for _low, _high in ((65, 91), (97, 123), (128, 256)):
    PLAIN[_low:_high] = LOWER[_low:_high]


def subwords(data: np.ndarray) -> list[np.ndarray]:
    """For each size, the bucket of the subword that begins at each byte; runs over two spaces are no subwords (-1)."""
    plain = PLAIN[data]
    found = []
    for size in SIZES:
        n = len(plain) - size + 1
        if n <= 0:
            found.append(np.zeros(0, np.int64))
            continue
        code = np.full(n, size, np.uint64)
        for j in range(size):
            code = code * np.uint64(257) + plain[j : j + n]
        bucket = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        blank = plain == 32
        bucket[blank[:n] & blank[1 : n + 1]] = -1
        found.append(bucket)
    return found


def text_buckets(column: pa.Array):
    """(text, bucket) of every subword of the texts, flat; a subword lies within one text."""
    data, offsets = utf8(column)
    for size, bucket in zip(SIZES, subwords(data), strict=True):
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(bucket)]
        inside = (np.arange(len(bucket)) + size <= offsets[1:][text]) & (bucket >= 0)
        yield text[inside], bucket[inside]


def short_run(text: str) -> str:
    """A run of 1 to 12 words of the text; place and length follow from the text."""
    words = text.split()
    rng = np.random.default_rng(zlib.crc32(text.encode()))
    at, n = rng.integers(0, max(1, len(words))), rng.integers(1, 13)
    return " ".join(words[at : at + n])


def runs_of_all_lengths(text: str) -> list[str]:
    """A run of 1, 2, 4 and so on words, up to LONGEST_RUN and the words of the text."""
    words = text.split()
    rng = np.random.default_rng(zlib.crc32(text.encode()) + 1)
    sizes = [1 << i for i in range(LONGEST_RUN.bit_length()) if 1 << i < len(words)]
    return [" ".join(words[at : at + n]) for n in sizes for at in [int(rng.integers(0, len(words) - n + 1))]]


def shuffled(text: str) -> str:
    """The text with its letters in another order; all else stays in its place."""
    letters = np.array(list(text), "U1")
    places = np.flatnonzero([c.isalpha() for c in text])
    rng = np.random.default_rng(zlib.crc32(text.encode()) + 2)
    letters[places] = letters[rng.permutation(places)]
    return "".join(letters.tolist())


def variants(batch: pa.RecordBatch):
    """Batches of the text and a short run of it; of a calibrating text also longer runs, and all of that as NOISE."""
    index, role_index = batch.schema.get_field_index("text"), batch.schema.get_field_index("role")
    texts, roles = batch.column("text").to_pylist(), batch.column("role").to_pylist()
    yield batch.set_column(index, "text", batch.column("text").cast(pa.string()))
    yield batch.set_column(index, "text", pa.array([short_run(t) for t in texts], pa.string()))
    for row in (i for i, role in enumerate(roles) if role == CALIBRATE):
        runs = runs_of_all_lengths(texts[row])
        given = [(t, CALIBRATE) for t in runs] + [(shuffled(t), NOISE) for t in (texts[row], short_run(texts[row]), *runs)]
        own = batch.take(pa.array([row] * len(given)))
        own = own.set_column(index, "text", pa.array([t for t, _ in given], pa.string()))
        yield own.set_column(role_index, "role", pa.array([r for _, r in given], batch.column("role").type))


def sample_features(batches):
    """Label, role and subword counts of each sampled text and of its variants: short texts are to be known too."""
    for batch in batches:
        for piece in (p for part in variants(batch) for p in pieces(part, "text")):
            counts = [dict() for _ in range(piece.num_rows)]
            for text, bucket in text_buckets(piece.column("text")):
                pair, n = np.unique(text << BUCKET_BITS | bucket, return_counts=True)
                for t, b, c in zip((pair >> BUCKET_BITS).tolist(), (pair & ((1 << BUCKET_BITS) - 1)).tolist(), n.tolist(), strict=True):
                    counts[t][b] = counts[t].get(b, 0) + c
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("label"),
                    piece.column("role"),
                    pa.array([np.array(list(c), np.int16).tobytes() for c in counts], pa.binary()),
                    pa.array([np.array(list(c.values()), np.int32).tobytes() for c in counts], pa.binary()),
                ],
                names=["label", "role", "buckets", "counts"],
            )


@dataclass(frozen=True)
class LanguageModel:
    """Labels, embeddings, linear layer, its bias, the temperature and the least confidence by length."""

    labels: tuple[str, ...]
    embed: np.ndarray
    linear: np.ndarray
    bias: np.ndarray
    temperature: float
    least: tuple[float, ...]

    @cached_property
    def layers(self) -> tuple[np.ndarray, np.ndarray | None]:
        """What is summed for each subword, and what the sum is multiplied by: the order that takes less memory."""
        if len(self.labels) > DIMENSIONS:
            return self.embed, self.linear
        return (self.embed @ self.linear).astype(np.float32), None

    def logits(self, column: pa.Array) -> np.ndarray:
        return self.measured(column)[0]

    def measured(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Logits and number of subwords of each text."""
        table, then = self.layers
        total = np.zeros((len(column), table.shape[1]))
        seen = np.zeros(len(column))
        for text, bucket in text_buckets(column):
            step = (1 << 22) // DIMENSIONS
            for at in range(0, len(text), step):  # a long text in steps
                own, rows = text[at : at + step], table[bucket[at : at + step]]
                starts = np.flatnonzero(np.diff(own, prepend=-1))
                total[own[starts]] += np.add.reduceat(rows, starts, axis=0, dtype=np.float64)
            seen += np.bincount(text, minlength=len(column))
        mean = total / np.maximum(seen, 1)[:, None]
        return (mean if then is None else mean @ then) + self.bias, seen

    def limits(self, subwords_: np.ndarray) -> np.ndarray:
        return np.array(self.least)[np.searchsorted(LENGTHS, subwords_, "right")]


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text has a letter; only texts without an ASCII letter are looked at as strings."""
    data, offsets = utf8(column)
    low = data | 32
    ascii_ = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122) & (data < 128))])
    found = ascii_[offsets[1:]] > ascii_[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in column[i].as_py() or "")
    return found


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def learn(texts: list, labels: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, linear layer and bias from (label, buckets, shares) of texts."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS))
    linear = rng.normal(0, 0.3, (DIMENSIONS, labels))
    bias = np.zeros(labels)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(texts)):
            label, buckets, share = texts[i]
            mean = share @ embed[buckets]
            error = softmax(mean @ linear + bias)
            error[label] -= 1
            # a step moves the mean of a long text as far as that of a short one
            embed[buckets] -= rate * np.outer(share, linear @ error) / (share @ share + 1e-3)
            linear -= 0.1 * rate * np.outer(mean, error)
            bias -= 0.01 * rate * error
        embed *= 1 - DECAY
    return embed.astype(np.float32), linear, bias


def best_temperature(raw: np.ndarray, truth: np.ndarray) -> float:
    rows = np.arange(len(truth))
    loss = {float(t): -np.log(softmax(raw / t)[rows, truth] + 1e-12).mean() for t in np.geomspace(0.1, 10, 41)}
    return min(loss, key=loss.get)


def weighed_quantile(values: np.ndarray, weights: np.ndarray, shares: np.ndarray) -> np.ndarray:
    order = np.argsort(values, kind="stable")
    reached = np.cumsum(weights[order])
    return values[order][np.minimum(np.searchsorted(reached, shares * reached[-1]), len(values) - 1)]


def least_confidence(right, right_subwords, foreign, foreign_subwords) -> tuple[float, ...]:
    """For each length the limit between WRONGLY_REJECTED and MOST_WRONGLY_REJECTED of the right rows that costs least.

    Rows of other lengths count a thousandth, or a millionth two steps away, and the fewer rows a limit rests on, the lower it is set.
    """
    if not len(right):
        return (0.0,) * (len(LENGTHS) + 1)
    shares = np.geomspace(WRONGLY_REJECTED, MOST_WRONGLY_REJECTED, 21)
    limits = []
    for length in range(len(LENGTHS) + 1):
        own, other = (
            OTHER_LENGTH ** np.abs(np.searchsorted(LENGTHS, n, "right") - length) for n in (right_subwords, foreign_subwords)
        )
        places = weighed_quantile(right, own, shares)
        stay = [other[foreign >= at].sum() / max(other.sum(), 1e-300) for at in places]
        best = places[int(np.argmin(KEEP_WEIGHT * shares + stay))]
        rows = min(own.sum(), other.sum())
        limits.append(float(best * rows / (rows + FEW_ROWS)))
    return tuple(limits)


def fit(rows: Iterable[tuple], seed: int = 7) -> LanguageModel:
    """A model from (label, role, buckets, counts) of sampled texts, those to learn from first and each role sorted.

    The texts to learn from are held; of the others only what the models say of them. The labels are dealt into
    LEFT_OUT_PARTS parts, and models without a part of them, as many whatever the labels, show how sure a model is of
    texts of a label that it did not learn.
    """
    train, labels, models, measured = [], [], [], []

    def learn_all() -> None:
        place = {label: i for i, label in enumerate(labels)}
        known = [(place[label], buckets, share) for label, buckets, share, _ in train]
        models.append((list(range(len(labels))), learn(known, len(labels), seed)))
        parts = min(len(labels), LEFT_OUT_PARTS)
        for part in range(parts):
            rest = [i for i in range(len(labels)) if i % parts != part]
            if len(rest) > 1:
                of_rest = {label: i for i, label in enumerate(rest)}
                own = [(of_rest[t[0]], *t[1:]) for t in known if t[0] in of_rest][::LEFT_OUT_EVERY]
                models.append((rest, learn(own, len(rest), seed)))

    def measure(label: str, role: int, buckets: np.ndarray, share: np.ndarray, total: float) -> None:
        if not models:
            learn_all()
        used = models if role != NOISE else models[:1]
        raw = [(share @ embed[buckets] @ linear + bias).astype(np.float32) for _, (embed, linear, bias) in used]
        measured.append((labels.index(label) if label in labels else -1, role, total, raw))

    for label, role, buckets, counts in rows:
        amount = np.frombuffer(counts, np.int32)
        if not len(amount):
            if role == TRAIN and label not in labels:
                labels.append(label)
            continue
        total = int(amount.sum())
        text = np.frombuffer(buckets, np.int16), (amount / total).astype(np.float32)
        if role == TRAIN:
            if not labels or labels[-1] != label:
                labels.append(label)
            train.append((label, *text, total))
        else:
            measure(label, role, *text, total)
    none = (0.0,) * (len(LENGTHS) + 1)
    if not labels:
        return LanguageModel((), np.zeros((1 << BUCKET_BITS, DIMENSIONS), np.float32), np.zeros((DIMENSIONS, 0)), np.zeros(0), 1.0, none)
    if not any(role == CALIBRATE for _, role, *_ in measured):
        for label, buckets, share, total in train:  # too few texts to hold any back
            measure(label, CALIBRATE, buckets, share, total)
    if not models:
        learn_all()
    (_, (embed, linear, bias)), *others = models
    held = [m for m in measured if m[1] == CALIBRATE]
    if not held:
        return LanguageModel(tuple(labels), embed, linear, bias, 1.0, none)
    raw, truth = np.array([m[3][0] for m in held], np.float64), np.array([m[0] for m in held])
    temperature = best_temperature(raw, truth)
    sure = softmax(raw / temperature)
    hit = sure.argmax(axis=1) == truth
    lengths = np.array([m[2] for m in held])
    noise = np.array([m[3][0] for m in measured if m[1] == NOISE], np.float64).reshape(-1, len(labels))
    foreign = [softmax(noise / temperature).max(axis=1)]
    foreign_lengths = [np.array([m[2] for m in measured if m[1] == NOISE])]
    for i, (rest, _) in enumerate(others):
        raw = np.array([m[3][1 + i] for m in held], np.float64)
        known = np.isin(truth, rest)
        if known.any() and not known.all():
            own = best_temperature(raw[known], np.searchsorted(rest, truth[known]))
            foreign.append(softmax(raw[~known] / own).max(axis=1))
            foreign_lengths.append(lengths[~known])
    least = least_confidence(sure.max(axis=1)[hit], lengths[hit], np.concatenate(foreign), np.concatenate(foreign_lengths))
    return LanguageModel(tuple(labels), embed, linear, bias, temperature, least)


def fit_in_task(batches):
    """One row with the model of all rows."""
    columns = ("label", "role", "buckets", "counts")
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
    model = fit(rows)
    yield pa.RecordBatch.from_pylist(
        [
            {
                "labels": list(model.labels),
                "embed": model.embed.astype(np.float32).tobytes(),
                "linear": model.linear.astype(np.float64).tobytes(),
                "bias": model.bias.astype(np.float64).tobytes(),
                "temperature": model.temperature,
                "least": list(model.least),
            }
        ]
    )


MODEL_ROW = "labels array<string>, embed binary, linear binary, bias binary, temperature double, least array<double>"


def train(docs: DataFrame, keep: Column, id_column: str, text_column: str, label_column: str) -> LanguageModel:
    """Model from the rows where ``keep`` holds, the text is not null and there is a label.

    The sample: of each label the ids with the smallest hash, SAMPLE_ROWS over all labels and evenly so far as there are ids; a
    fifth of them calibrates. Of an id with several rows, however many, the least label counts and the least text that has it. Features are
    made in tasks, one task learns from those of the sample, and only the model, 1 MB and some bytes a label, reaches the driver.
    """
    usable = keep & F.col(label_column).isNotNull() & F.col(text_column).isNotNull() & F.col(id_column).isNotNull()
    order = F.xxhash64(F.col(id_column).cast("string"), F.lit("sample"))
    known = docs.where(usable).select(
        F.col(id_column).alias("_id"),
        F.col(label_column).cast("string").alias("label"),
        F.shiftrightunsigned(order, 11).alias("order"),
    )
    rank = F.row_number().over(Window.partitionBy("label").orderBy("order", "_id"))
    # Hashes low enough for about four times what is wanted, so no label brings many rows together.
    numbers = known.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(FREQUENT_LABELS)
    low = F.col("order") / F.lit(float(1 << 53)) * F.coalesce("n", F.lit(0)) < F.lit(4.0 * MOST_PER_LABEL)
    picked = (
        known.join(F.broadcast(numbers), "label", "left")  # FREQUENT_LABELS rows; rarer labels keep all of theirs
        .where(low)
        .groupBy("_id")
        .agg(F.min("label").alias("label"), F.min("order").alias("order"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= MOST_PER_LABEL)
        .orderBy("rank", "order", "_id")
        .limit(SAMPLE_ROWS)
        .select("_id", "label", F.when(F.col("rank") % 5 == 0, CALIBRATE).otherwise(TRAIN).alias("role"))
    )
    texts = docs.where(usable).select(
        F.col(id_column).alias("_id"), F.col(label_column).cast("string").alias("label"), F.col(text_column).cast("string").alias("text")
    )
    sampled = texts.join(F.broadcast(picked), ["_id", "label"])  # SAMPLE_ROWS ids
    features = (
        sampled.groupBy("_id", "label", "role")
        .agg(F.min("text").alias("text"))
        .select("label", "role", "text")
        .mapInArrow(sample_features, "label string, role int, buckets binary, counts binary")
    )
    row = (
        features.repartition(1)
        .sortWithinPartitions("role", "label", "buckets", "counts")
        .mapInArrow(fit_in_task, MODEL_ROW)
        .first()
    )
    if row is None:
        return fit([])
    return LanguageModel(
        tuple(row["labels"]),
        np.frombuffer(row["embed"], np.float32).reshape(-1, DIMENSIONS),
        np.frombuffer(row["linear"]).reshape(DIMENSIONS, -1),
        np.frombuffer(row["bias"]),
        row["temperature"],
        tuple(row["least"]),
    )


def predict(
    docs: DataFrame,
    model: LanguageModel,
    text_column: str = "text",
    names: tuple[str, str, str] = ("lang_pred", "score", "rejected"),
) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected, or other ``names``; columns so named are replaced.

    A text that is null or has no letter is UNKNOWN with score 0 and rejected. Any other text gets a label, and is rejected if its
    calibrated confidence is below the model's limit for texts of its length. Nothing but the text is looked at; rows are independent. Without a
    learned label every text is UNKNOWN.
    """
    parts = (model.labels, model.embed, model.linear, model.bias, model.temperature, model.least)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches):
        model = LanguageModel(*shared.value)
        labels = np.array([*model.labels, UNKNOWN], object)
        for batch in batches:
            for piece in pieces(batch, text_column):
                column = piece.column(piece.schema.get_field_index(text_column))
                known = has_letter(column) if model.labels else np.zeros(len(column), bool)
                best, score = np.full(len(column), len(model.labels)), np.zeros(len(column))
                least = np.zeros(len(column))
                if known.any():
                    raw, subwords_ = model.measured(column)
                    sure, least = softmax(raw / model.temperature), model.limits(subwords_)
                    best[known] = sure.argmax(axis=1)[known]
                    score[known] = np.clip(sure.max(axis=1)[known], 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *piece.columns,
                        pa.array(labels[best], pa.string()),
                        pa.array(score),
                        pa.array(~known | (score < least)),
                    ],
                    names=[*piece.schema.names, *names],
                )

    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    added = [T.StructField(name, kind) for name, kind in zip(names, kinds, strict=True)]
    kept = docs.drop(*names)
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


def keep_known(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> DataFrame:
    """``docs`` without the texts that the model rejects; where the label is null it becomes the predicted one.

    The model learns from the rows of ``docs`` that have a label. Without any there is nothing to judge by, and all rows
    stay as they are. All columns stay.
    """
    model = train(docs, F.lit(True), id_column, text_column, label_column)
    if not model.labels:
        return docs
    names = ("_llm_lang", "_llm_score", "_llm_rejected")
    predicted = predict(docs, model, text_column, names).where("not _llm_rejected")
    label = F.coalesce(F.col(label_column), F.col("_llm_lang").cast(docs.schema[label_column].dataType))
    return predicted.withColumn(label_column, label).select(docs.columns)
