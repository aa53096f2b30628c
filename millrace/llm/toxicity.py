"""Toxic texts, by two Kneser-Ney models of byte sequences.

A text is lower-cased, whatever is no letter becomes one blank, and each byte is predicted from
the ``ORDER - 1`` before it, once by the model of toxic texts and once by that of ordinary ones. Both
discount what they saw and hand the rest to the same shorter contexts, one byte shorter at a time, whose
continuation counts come from the whole corpus, labelled or not: an expression that is rare in one
class is then no evidence in itself.

The margin is the difference of both log-likelihoods over the number of bytes predicted; a sigmoid
fitted on labelled texts that the models for that step had not seen makes it a probability.

Sequences are exact numbers throughout, and each has its own difference. The differences are counted: up to
``SENT`` of them are sent to the tasks as a sorted array, more are joined to the sequences of the texts.
Both give the same margins, as differences are multiples of ``STEP`` whose sums have no rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import SALTS, query, table, unused
from millrace.llm.labelled import fold, probability, sampled, sigmoid_fit, with_label, with_margins
from millrace.llm.tokens import KINDS, slices, text_column
from millrace.session import stored

ORDER = 5
#: All sequences there can be: each is its own bin.
BINS = 1 << 8 * ORDER
#: So many differences, of 16 bytes, are sent to the tasks at most.
SENT = 4_000_000
STEP = 2.0 ** -24
DISCOUNT = 0.75
#: What is left of single bytes' counts goes to so many bytes alike.
SYMBOLS = 64
#: About so many labelled texts the probability is fitted on (the models read all of them).
FIT_ROWS = 8_000
THRESHOLD = 0.7
#: So many bytes of text are cut into sequences at once, or one text if it is longer.
SLICE = 1 << 18
#: Below so many held distinct sequences a task goes on adding up before it hands them over.
HELD = 1 << 20
#: Sequences are added up when they are twice as many as the distinct ones last time, and twice this number at least.
FOLDED = 1 << 18


def sequences(bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, row) for each byte of the rows' normalised texts.

    A row begins with blanks; the low byte of a sequence is the byte that the others predict.
    """
    part = data[bounds[0]:bounds[-1]]
    size = np.diff(bounds)
    rows = np.arange(len(size))
    letters = np.where(KINDS[part] == 1, part, 32).astype(np.uint8)
    pad = ORDER - 1
    whole = np.full(len(part) + pad * len(size), 32, np.uint8)
    row = np.repeat(rows, size + pad)
    at = np.arange(len(part)) + np.repeat((rows + 1) * pad, size)
    whole[at] = letters
    keep = np.ones(len(whole), bool)
    keep[1:] = (whole[1:] != 32) | (whole[:-1] != 32)
    first = np.concatenate(([0], np.cumsum(size + pad)[:-1])) if len(size) else rows
    for k in range(pad):
        keep[first + k] = True
    whole, row = whole[keep].astype(np.int64), row[keep]
    out = whole.copy()
    for k in range(1, ORDER):
        out[k:] |= whole[:-k] << (8 * k)
    begins = np.searchsorted(row, rows)
    inside = np.ones(len(out), bool)
    for k in range(pad):
        inside[begins + k] = False
    return out[inside], row[inside]


_SEQUENCE = (1 << 8 * ORDER) - 1


def _told(keyed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order, and how often each is there."""
    keyed = np.sort(keyed)
    first = np.flatnonzero(np.concatenate(([True], keyed[1:] != keyed[:-1]))) if len(keyed) else keyed
    return keyed[first], np.diff(np.append(first, len(keyed)))


def _lowered(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    at = batch.schema.get_field_index("text")
    lowered = pc.utf8_lower(batch.column(at))
    return text_column(pa.RecordBatch.from_arrays([lowered], ["text"]), "text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seq, part, n): how often texts of each part of the corpus hold a sequence."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def fold_in():
        keyed = np.concatenate([x[0] for x in held])
        order = np.argsort(keyed, kind="stable")
        keyed, number = keyed[order], np.concatenate([x[1] for x in held])[order]
        first = np.flatnonzero(np.concatenate(([True], keyed[1:] != keyed[:-1])))
        held[:] = [(keyed[first], np.add.reduceat(number, first))]

    def out():
        if held:
            fold_in()
            keyed, number = held.pop()
            for at in range(0, len(keyed), 1 << 16):
                part = slice(at, at + (1 << 16))
                columns = [pa.array(keyed[part] >> 3), pa.array((keyed[part] & 7).astype(np.int32)), pa.array(number[part])]
                yield pa.RecordBatch.from_arrays(columns, ["seq", "part", "n"])

    most = 2 * FOLDED
    for batch in batches:
        bounds, data = _lowered(batch)
        kind = batch.column(batch.schema.get_field_index("part")).to_numpy(zero_copy_only=False)
        for low, high in slices(bounds, SLICE):
            seq, row = sequences(bounds[low:high + 1], data)
            if not len(seq):
                continue
            held.append(_told(seq * 8 + kind[low:high][row]))
            if sum(len(x[0]) for x in held) > most:
                fold_in()
                most = 2 * max(FOLDED, len(held[0][0]))
                if len(held[0][0]) > HELD:
                    yield from out()
                    most = 2 * FOLDED
    yield from out()


def counted(docs: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """seq, n, t0, o0, t1, o1: how often it is there, in all, and in toxic and ordinary halves."""
    half = fold("doc_id", 8) % 2
    part = F.when(F.col("label").isNull() | ~train, 0).otherwise(half * 2 + F.when(F.col("label") == 1, 1).otherwise(2))
    rows = with_label(docs, labels, "toxic").select("text", part.cast("int").alias("part"))
    return (
        rows.mapInArrow(_count, "seq long, part int, n long").groupBy("seq").agg(
            F.sum("n").alias("n"),
            *[F.sum(F.when(F.col("part") == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(("t0", "o0", "t1", "o1"), 1)],
        )
    )


def _shared(ends: DataFrame, size: int) -> DataFrame:
    """(g, p): the shared model's probability of the last of each ``size`` bytes g after the others.

    ``ends`` holds g once for each byte that was seen before it. What is discounted goes on to the
    contexts one byte shorter, whose own counts are of the distinct g that end alike, and behind
    single bytes to ``SYMBOLS`` alike.
    """
    d = F.lit(DISCOUNT)
    continued = ends.groupBy("g").agg(F.count(F.lit(1)).alias("c"))
    context = F.shiftright("g", 8).alias("h")
    totals = continued.groupBy(context).agg(F.sum("c").alias("s"), F.count(F.lit(1)).alias("k"))
    joined = continued.select("g", "c", context).join(totals, "h")
    if size == 1:
        return joined.select("g", ((F.col("c") - d + d * F.col("k") / SYMBOLS) / F.col("s")).alias("p"))
    end = F.col("g").bitwiseAND(F.lit((1 << 8 * (size - 1)) - 1))
    lower = _shared(continued.select(end.alias("g")), size - 1).withColumnsRenamed({"g": "end", "p": "q"})
    return joined.withColumn("end", end).join(lower, "end").select(
        "g", ((F.col("c") - d + d * F.col("k") * F.col("q")) / F.col("s")).alias("p")
    )


def _shorter() -> Column:
    return F.col("seq").bitwiseAND(F.lit((1 << 8 * (ORDER - 1)) - 1)).alias("g")


def shared_model(counts: DataFrame) -> DataFrame:
    """(g, p): the shared model's probabilities of what the sequences of the whole corpus end in, stored."""
    return stored(_shared(counts.select(_shorter()), ORDER - 1), "shared-model")


def differences(counts: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """(kind, bin, value): log-likelihood differences of sequences (0) and of contexts (1).

    ``counts`` holds seq, n (whole corpus), t and o (classes). A sequence that neither class has
    costs each class its context's left-over mass: that is the context's value. ``shared`` is the
    ``shared_model`` of the same sequences, if it is there already.
    """
    d = F.lit(DISCOUNT)
    shorter = _shorter()
    if shared is None:
        shared = _shared(counts.select(shorter), ORDER - 1)
    seen = counts.where("t + o > 0").select("seq", "t", "o", F.shiftright("seq", 8).alias("ctx"))
    contexts = seen.groupBy("ctx").agg(
        F.sum("t").alias("st"), F.sum("o").alias("so"),
        F.count_if(F.col("t") > 0).alias("kt"), F.count_if(F.col("o") > 0).alias("ko"),
    )
    rest = lambda k, s: F.when(F.col(s) > 0, d * F.col(k) / F.col(s)).otherwise(1.0)
    contexts = contexts.select("ctx", "st", "so", rest("kt", "st").alias("rt"), rest("ko", "so").alias("ro"))
    own = lambda c, s: F.when(F.col(c) > 0, (F.col(c) - d) / F.col(s)).otherwise(0.0)
    known = (
        seen.join(contexts, "ctx").withColumn("g", shorter).join(shared, "g")
        .select(
            "seq", (F.col("t") + F.col("o")).alias("w"),
            (F.log(own("t", "st") + F.col("rt") * F.col("p")) - F.log(own("o", "so") + F.col("ro") * F.col("p"))).alias("v"),
        )
    )
    stepped = lambda v: (F.rint(v / F.lit(STEP)) * F.lit(STEP)).alias("value")
    return known.select(F.lit(0).alias("kind"), F.col("seq").alias("bin"), stepped(F.col("v"))).unionByName(
        contexts.select(F.lit(1).alias("kind"), F.col("ctx").alias("bin"), stepped(F.log("rt") - F.log("ro")))
    )


def model(counts: DataFrame, shared: DataFrame | None = None) -> DataFrame | None:
    """The differences, stored.

    None where one of the classes has no sequence: there is nothing to compare.
    """
    both = counts.agg(F.sum("t"), F.sum("o")).first()
    return stored(differences(counts, shared), "differences") if both[0] and both[1] else None


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the wanted keys, NaN where there is none."""
    if not len(keys):
        return np.full(len(wanted), np.nan)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], np.nan)


def with_difference(docs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``docs`` with the margin of each text, 0 for a blank one."""
    return (_with_sent if found.count() <= SENT else _with_joined)(docs, found, name)


def _with_sent(docs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    rows = found.toArrow()
    kind, keys, values = (rows.column(c).to_numpy() for c in ("kind", "bin", "value"))
    arrays = []
    for which in (0, 1):
        of = np.flatnonzero(kind == which)
        of = of[np.argsort(keys[of], kind="stable")]
        arrays += [keys[of], values[of]]
    shared = docs.sparkSession.sparkContext.broadcast(arrays)

    def scorer():
        known, known_values, contexts, context_values = shared.value

        def score(batch: pa.RecordBatch) -> np.ndarray:
            bounds, data = _lowered(batch)
            out = np.zeros(len(batch))
            for low, high in slices(bounds, SLICE):
                seq, row = sequences(bounds[low:high + 1], data)
                value = _looked_up(known, known_values, seq)
                unseen = np.flatnonzero(np.isnan(value))
                value[unseen] = np.nan_to_num(_looked_up(contexts, context_values, seq[unseen] >> 8))
                held = np.bincount(row, minlength=high - low)
                out[low:high] = np.bincount(row, value, high - low) / np.maximum(held, 1)
            return out

        return score

    return with_margins(docs, scorer, name)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, seq, times) for each distinct sequence of each text, and one of -1 for each text."""
    for batch in batches:
        bounds, data = _lowered(batch)
        digests = batch.column(batch.schema.get_field_index("digest"))
        for low, high in slices(bounds, SLICE):
            seq, row = sequences(bounds[low:high + 1], data)
            keyed, times = _told((row << 8 * ORDER) | seq)
            row = np.concatenate((np.arange(high - low), keyed >> 8 * ORDER)) + low
            seq = np.concatenate((np.full(high - low, -1), keyed & _SEQUENCE))
            times = np.concatenate((np.zeros(high - low, np.int64), times))
            for at in range(0, len(seq), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [digests.take(pa.array(row[part])), pa.array(seq[part]), pa.array(times[part])], ["digest", "seq", "times"]
                )


def _with_joined(docs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """A margin depends on the text alone, so it is found for each digest of a text.

    A sequence that most texts hold is looked up in ``SALTS`` parts.
    """
    columns = [c for c in docs.columns if c != name]
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    held = (
        docs.select("text", digest.alias("digest")).mapInArrow(_held, "digest binary, seq long, times long")
        .withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)))
    )
    known = found.where("kind = 0").select(F.col("bin").alias("seq"), F.col("value").alias("known"))
    contexts = found.where("kind = 1").select(F.col("bin").alias("ctx"), F.col("value").alias("context"))
    lookup = (
        held.where("seq >= 0").select("seq", "salt").distinct().join(known, "seq", "left")
        .withColumn("ctx", F.shiftright("seq", 8)).join(contexts, "ctx", "left")
        .select("seq", "salt", F.coalesce("known", "context", F.lit(0.0)).alias("value"))
    )
    own = unused(columns, "_digest")
    margins = held.join(lookup, ["seq", "salt"], "left").groupBy(F.col("digest").alias(own)).agg(
        (F.coalesce(F.sum(F.col("value") * F.col("times")), F.lit(0.0)) / F.greatest(F.sum("times"), F.lit(1))).alias(name)
    )
    return docs.select(*columns, digest.alias(own)).join(margins, own).select(*columns, name)


def with_toxicity(docs: DataFrame, corpus: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """``docs`` with toxicity: 0 to 1, higher: label 1 likelier.

    ``corpus`` (doc_id, text) is what the shared counts are taken from, ``labels`` (doc_id, toxic)
    its labels, and only rows under the condition ``train`` on doc_id lend theirs. NULL
    texts score as empty ones; of several labels of a doc_id the largest counts. Without a
    label of either class every score is 0. A column of that name is replaced.
    """
    counts = stored(counted(corpus, labels, train), "sequences")
    # both models end alike, and that is found once
    shared = shared_model(counts)
    halves = model(counts.selectExpr("seq", "n", "t0 AS t", "o0 AS o"), shared)
    whole = model(counts.selectExpr("seq", "n", "t0 + t1 AS t", "o0 + o1 AS o"), shared)
    if whole is None:
        return docs.withColumn("toxicity", F.lit(0.0))
    slope, offset = 1.0, 0.0
    if halves is not None:
        unseen = sampled(
            with_label(corpus.where(train & (fold("doc_id", 8) % 2 == 1)), labels, "toxic", "inner"), FIT_ROWS
        )
        fitted = with_difference(unseen.select("text", "label"), halves, "margin").select("margin", "label").toArrow()
        # in one order, so that sums of the fit do not depend on that of the rows
        fitted = fitted.sort_by([("margin", "ascending"), ("label", "ascending")])
        margin, label = fitted.column("margin").to_numpy(), fitted.column("label").to_numpy()
        if 0 < label.sum() < len(label):
            slope, offset = sigmoid_fit(margin, label)
    columns = [c for c in docs.columns if c != "toxicity"]
    margin = unused(columns, "_margin")
    scored = with_difference(docs.select(*columns), whole, margin)
    return scored.select(*columns, probability(F.col(margin), slope, offset).alias("toxicity"))


def train_rows() -> Column:
    return fold("doc_id", 3) != 1


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with their own columns."""
    scored = with_toxicity(docs, docs.select("doc_id", "text"), labels, train_rows())
    return scored.where(F.col("toxicity") < threshold).select(*docs.columns)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_toxicity(docs, docs, table(spark, sf_dir, "labels"), train_rows())
    return scored.select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
