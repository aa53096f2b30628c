"""Texts that share most of their word n-grams, by a join on parity sketches.

A text is the set of its shingles. For sets of sizes a and b, a Jaccard similarity of at least t
means that at most (a + b)(1 - t) / (1 + t) shingles lie in one set only. Each shingle
flips bits of one word of a sketch, so shingles of both sets cancel out and two sketches differ in no more
words than that. A sketch has one 64-bit word more than shingles may differ, hence linked sets
agree in a whole word: that word, with its place, is the join key. A shingle flips the bits of its own 64-bit
code there. If it flipped one bit, words of two or three shingles would be equal by chance, the more often the more sets
there are: pairs that have nothing in common would grow with the square of the sets. Words of one shingle, or none,
say little, so a sketch has some more words than that, and each set leaves out its thinnest ones, as many
as linked sets can spare. Of words that agree both leave out the same first, as their order is that of
shingles in them and of their bits. Sketches of more than a few
words get ``EXTRA`` words on top, so that linked sets agree in one more than that: sets which share a
passage agree in a word now and then, hardly ever in several.

How many words there are depends on the size, so sizes are cut into bands. A set takes part in the
band of its own size, and in the next ones as long as a set from there could still be similar.

Equal words only say which sets to look at. Pairs of sets with words enough in common must keep the
bound on a second sketch, in which a shingle flips one bit. It grows with the set, in doublings, so that sets with nothing in common differ in more
bits than the bound allows, however large they are; of two sketches the larger one is folded onto the smaller. Where many sets have a word, no pairs are made: they
meet in blocks, and a block returns ties that connect what keeps the bound, at most one for
each set. What the ties connect is compared in blocks again, now by the shingles themselves.
Pairs that are connected already are not compared, and again only links that connect come out.

Shingles are 64-bit hashes of their words; sets are the same when their size and 128 bits of
their hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import query, table, with_group
from millrace.llm.links import components
from millrace.llm.tokens import chain, mix, per_row, slices, text_column, words
from millrace.session import stored

#: Each band's sizes go up to about this many times its smallest.
BAND = 1.6
#: Sets that share a word are paired up to so many, and compared in blocks beyond.
PAIRED = 16
#: Linked sets agree in so many words and one more, if their sketches may differ in at least so many.
EXTRA, MANY_WORDS = 3, 16
#: Bytes of texts whose sets are worked on at once.
SETS_BYTES = 1 << 20
#: 64-bit words of the second sketch at least.
PLAIN_WORDS = 8
#: Texts of one block; two blocks are compared in one task.
BLOCK = 1024
#: So many words of sketches are compared at once, or one set's with all others.
AT_ONCE = 1 << 15
#: Crowded words are compared in so many queries at most, of so many rows at least: each one's shuffle can go before the next.
CROWD_PARTS, CROWD_ROWS = 4, 500_000
#: So many rows of two numbers are broadcast at most, more are shuffled.
BROADCAST_ROWS = 2_000_000


def shingle_sets(bounds: np.ndarray, data: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each row the sorted hashes of its distinct shingles.

    A text of fewer words than ``width`` is one shingle, one without words none.
    """
    found = words(bounds, data)
    begins = per_row(found.row, len(bounds) - 1).tolist()
    chained = chain(found.hash, width)
    for low, high in zip(begins[:-1], begins[1:]):
        if high - low >= width:
            own = np.sort(chained[low:high - width + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        else:
            yield chain(found.hash[low:high], high - low) if high > low else found.hash[:0]


class Sets:
    """Sets of shingles, one behind the other: set i is ``flat[begins[i]:begins[i + 1]]``."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.size)))
        self.flat = np.concatenate([np.zeros(0, np.uint64), *sets])

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that stand for each set."""
        spread = mix(self.flat ^ np.uint64(0x632BE59BD9B4E019))
        one, two = np.zeros((2, len(self.size)), np.uint64)
        real = np.flatnonzero(self.size)
        if len(real):
            one[real] = np.bitwise_xor.reduceat(spread, self.begins[real])
            two[real] = np.add.reduceat(mix(spread), self.begins[real])
        return one.view(np.int64), two.view(np.int64)

    def dealt(self, of: np.ndarray, seed: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingles of the sets ``of``, spread, and their places: each of these sets has ``count`` of its own."""
        size = self.size[of]
        ends = np.cumsum(size)
        at = np.repeat(self.begins[of] - ends + size, size) + np.arange(size.sum())
        spread = mix(self.flat[at] + np.repeat(seed.astype(np.uint64), size))
        own = ((spread >> np.uint64(6)) % np.repeat(count.astype(np.uint64), size)).astype(np.int64)
        return spread, own + np.repeat(np.cumsum(count) - count, size)

    def sketches(self, count: np.ndarray, seed: int) -> np.ndarray:
        """``count`` words of 64 bits for each set, one behind the other; each shingle flips one bit."""
        spread, place = self.dealt(np.arange(len(count)), np.full(len(count), seed), count)
        out = np.zeros(count.sum(), np.uint64)
        np.bitwise_xor.at(out, place, np.uint64(1) << (spread & np.uint64(63)))
        return out

    def key_words(self, of: np.ndarray, low: np.ndarray, count: np.ndarray, least: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """``least`` words of the sketch of each of the sets ``of``, hashed with their places; the thinnest are left out.

        Words are in order by their shingles and bits, so of words in which two sets agree both leave out the
        same first. The last bit says that one word in common is enough, as nothing is extra.
        """
        spread, place = self.dealt(of, low, count)
        out, sketch_of = np.zeros(count.sum(), np.uint64), np.repeat(np.arange(len(of)), count)
        np.bitwise_xor.at(out, place, mix(spread))
        shingles = np.bincount(place, minlength=len(out))
        first = np.cumsum(count) - count
        name = np.arange(len(out)) - first[sketch_of] + (low << 32)[sketch_of]
        order = np.lexsort((out, shingles, sketch_of))
        stay = order[np.arange(len(out)) >= (first + count - least)[sketch_of]]
        enough = (extra == 0).astype(np.uint64)[sketch_of[stay]]
        return mix(out[stay] + mix(name[stay].astype(np.uint64))) & ~np.uint64(1) | enough


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[list[np.ndarray]]:
    """The sets of some rows at once, in order."""
    bounds, data = text_column(batch, "text")
    for low, high in slices(bounds, SETS_BYTES):
        yield list(shingle_sets(bounds[low:high + 1], data, width))


def differing(total: int, percent: int) -> int:
    """How many shingles may lie in one set only, for sets of ``total`` shingles together."""
    return total * (100 - percent) // (100 + percent)


def bands(size: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(smallest size, words of a sketch, spare, extra) of each band that a set takes part in."""
    low, found = 1, []
    while low * percent <= size * 100:
        if _largest(low) >= size:
            found.append(low)
        low = _largest(low) + 1
    return [(low, *_words_for(low, _largest(low), percent)) for low in found]


def _largest(low: int) -> int:
    """The largest size of the band from ``low`` on."""
    return max(low, int((low - 1) * BAND))


def _entered(size: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(smallest size, words of a sketch, words entered, extra) of each band that a set takes part in.

    In a band a set meets sets up to the band's largest, and not more than so many shingles differ.
    """
    return [
        (low, count, differing(size + min(_largest(low), size * 100 // percent), percent) + 1 + extra, extra)
        for low, count, _, extra in bands(size, percent)
    ]


def _words_for(low: int, high: int, percent: int) -> tuple[int, int, int]:
    """(words, spare, extra): linked sets agree in one more word than are spare and extra.

    Spare are about as many as have one shingle or none in a set from the middle of the band.
    """
    needed = differing(2 * high, percent) + 1
    share = (low + high) / 2 / needed
    thin = min(0.3, np.exp(-share) * (1 + share))
    spare = 2 + int(1.2 * needed * thin / (1 - thin))
    extra = EXTRA if needed >= MANY_WORDS else 0
    return needed + spare + extra, spare, extra


def sketch(shingles: np.ndarray, count: int, seed: int) -> np.ndarray:
    """``count`` words of 64 bits, one bit of which each shingle flips."""
    spread = mix(shingles + np.uint64(seed))
    place = ((spread >> np.uint64(6)) % np.uint64(count)).astype(np.int64)
    out = np.zeros(count, np.uint64)
    np.bitwise_xor.at(out, place, np.uint64(1) << (spread & np.uint64(63)))
    return out


def plain_words(size: int, percent: int) -> int:
    """Words of a set's second sketch: 5 bits for 2 shingles that the set and a larger one, linked to it, may differ in.

    Half of the bits differ for sets with nothing in common, a quarter more than that.
    """
    count = PLAIN_WORDS
    while 2 * 64 * count * percent < 5 * size * (100 - percent):
        count *= 2
    return count


def fold(words_: np.ndarray, count: int) -> np.ndarray:
    """The sketch of ``count`` words of the same set, from one of a multiple of that."""
    return words_ if len(words_) == count else np.bitwise_xor.reduce(words_.reshape(-1, count))


def _fold(words_: Column, count: Column) -> Column:
    return F.when(F.size(words_) == count, words_).otherwise(F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.aggregate(F.sequence(i, F.size(words_) - 1, count), F.lit(0).cast("long"), lambda t, k: t.bitwiseXOR(F.get(words_, k))),
    ))


def key_words(shingles: np.ndarray, low: int, count: int, spare: int, extra: int) -> np.ndarray:
    """The words of one set's sketch in the band from ``low`` on that are not spare, hashed with their places."""
    facts = (np.array([x]) for x in (low, count, count - spare, extra))
    return Sets([shingles]).key_words(np.zeros(1, np.int64), *facts)


def _described(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, one, two, plain: size, marks and second sketch of each row's set."""

    def describe(batches):
        for batch in batches:
            done = 0
            for found in map(Sets, _sets(batch, width)):
                count = np.array([plain_words(n, percent) for n in found.size.tolist()], np.int64)
                ends = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
                plain = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.sketches(count, 1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(count)), pa.array(found.size), *map(pa.array, found.marks()), plain],
                    ["doc_id", "n", "one", "two", "plain"],
                )
                done += len(count)

    return docs.select("doc_id", "text").mapInArrow(
        describe, "doc_id long, n long, one long, two long, plain array<long>"
    )


def _ties(entries: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """(a, b): ties between sets, by their first mark, that connect all sets which may be linked.

    A word's rows are two numbers each, and a set has many words: even the words of a group with a
    third of all sets are a small part of the rows each.
    """
    by_word = Window.partitionBy("key")
    in_order = by_word.orderBy("one")
    shared = (
        entries.repartition(F.col("key")).dropDuplicates(["key", "one"])
        .withColumn("many", F.count(F.lit(1)).over(by_word)).where("many > 1")
        .withColumn("nth", F.row_number().over(in_order))
        .withColumn("sets", F.collect_list("one").over(in_order.rowsBetween(1 - PAIRED, 0)))
    )
    # a word of few sets is one row with all of them, a crowded word a row for each
    crowd = F.col("many") > PAIRED
    met = stored(shared.where(crowd | (F.col("nth") == F.col("many"))).select(
        "key", F.when(crowd, F.array("one")).otherwise(F.col("sets")).alias("sets"),
        F.when(crowd, F.ceil(F.col("many") / BLOCK)).otherwise(0).cast("int").alias("blocks"),
    ), "shared-words")
    facts = stored(described.where("n > 0").select("one", "n", "plain").distinct(), "set-facts")
    side = lambda name: facts.select(*[F.col(c).alias(d) for c, d in zip(facts.columns, (name, f"n_{name}", f"plain_{name}"))])
    count = F.least(F.size("plain_a"), F.size("plain_b"))
    apart = F.aggregate(
        F.zip_with(_fold(F.col("plain_a"), count), _fold(F.col("plain_b"), count), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0), lambda t, x: t + x,
    )
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    near = (small * 100 >= large * percent) & (apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))
    # linked sets have more words in common than are extra, or one of a word that is enough, or a crowded one
    paired = met.where("blocks = 0").select(
        F.posexplode("sets").alias("nth", "a"), "sets", F.when(F.col("key") % 2 != 0, EXTRA + 1).otherwise(1).alias("weight"),
    ).select("a", F.explode(F.expr(f"slice(sets, nth + 2, {PAIRED})")).alias("b"), "weight")
    pairs = paired.groupBy("a", "b").agg(F.sum("weight").alias("weight")).where(f"weight > {EXTRA}")
    few = pairs.join(side("a"), "a").join(side("b"), "b").where(near).select("a", "b")
    crowded = met.where("blocks > 0").select("key", F.col("sets")[0].alias("one"), "blocks")
    rows = crowded.count()
    parts = min(CROWD_PARTS, 1 + rows // CROWD_ROWS)

    def sketched(frame: pd.DataFrame):
        n, plain = frame["n"].to_numpy(), [p.view(np.uint64) for p in frame["plain"]]
        return lambda part: (n[part], plain[part], None)

    def tie(frame: pd.DataFrame) -> pd.DataFrame:
        return _connected(frame, "key", "one", sketched, percent)

    # one query after the other: what they shuffle, sketches above all, need not lie on disk together
    ties = stored(few, "ties")
    for part in range(parts):
        own = crowded.where(F.pmod(F.xxhash64("key", F.lit("part")), F.lit(parts)) == part)
        many = _in_blocks(own.join(facts, "one"), "key", "one", ["n", "plain"], rows // parts // BLOCK)
        ties = ties.unionByName(stored(many.applyInPandas(tie, "a long, b long"), "ties"))
    return ties


def _in_blocks(rows: DataFrame, group: str, key: str, columns: list[str], buckets: int):
    """Rows grouped so that any two rows of a ``group`` meet in a task, of two blocks at most.

    ``blocks`` is the number of blocks of a row's group; groups of one block share tasks.
    """
    placed = rows.withColumn("split", F.col("blocks") > 1).withColumn(
        "bucket", F.when(F.col("split"), F.col(group)).otherwise(F.pmod(F.xxhash64(group), F.lit(max(1, buckets))))
    ).withColumn("side", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        group, key, *columns, "side", "split", "bucket",
        F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"),
    ).groupBy("split", "bucket", "low", "high")


def _connected(frame: pd.DataFrame, group: str, key: str, described, percent: int) -> pd.DataFrame:
    """(a, b): what ``connect`` finds in each group of a task's rows; ``described(frame)`` tells of a slice what it takes."""
    pairs = []
    crossed = frame["low"].iloc[0] != frame["high"].iloc[0]
    frame = frame.sort_values(group, kind="stable", ignore_index=True)
    groups, ids, side = (frame[c].to_numpy() for c in (group, key, "side"))
    of = described(frame)
    begins = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1], [True])))
    for part in map(slice, begins[:-1].tolist(), begins[1:].tolist()):
        if part.stop - part.start > 1 and not (crossed and (side[part] == side[part.start]).all()):
            own = ids[part]
            pairs += [(own[i], own[j]) for i, j in connect(*of(part), side[part], crossed, percent)]
    return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def _entries(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(key, one): the words of each set's sketches, hashed with their places."""

    def enter(batches):
        known: set[int] = set()  # copies within a task are entered once
        bands_of: dict[int, list] = {}
        for batch in batches:
            for found in map(Sets, _sets(batch, width)):
                one, two = found.marks()
                taken = []
                for i, (size, mark) in enumerate(zip(found.size.tolist(), two.tolist())):
                    if size and mark not in known:
                        known.add(mark)
                        if size not in bands_of:
                            bands_of[size] = _entered(size, percent)
                        taken += [(i, *band) for band in bands_of[size]]
                if taken:
                    of, low, count, least, extra = np.array(taken).T
                    key = found.key_words(of, low, count, least, extra)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.repeat(one[of], least))], ["key", "one"]
                    )

    return docs.select("text").mapInArrow(enter, "key long, one long")


def connect(
    size: np.ndarray, sketches: list[np.ndarray], sets: list[np.ndarray] | None, side: np.ndarray,
    crossed: bool, percent: int,
) -> list[tuple[int, int]]:
    """Pairs (i, j) that connect all sets which near pairs connect, as few as needed.

    Near are pairs whose sketches keep the bound and, if ``sets`` are given, that are similar.
    With ``crossed`` only sets of different sides are compared. A larger set's sketch has as many words or a multiple.
    """
    order = np.argsort(size, kind="stable")
    size, side = size[order], side[order]
    counts = np.array([len(sketches[i]) for i in order])
    # for each number of words the sets with so many or more, in that many words
    firsts = {count: int(np.searchsorted(counts, count)) for count in np.unique(counts)}
    folded = {count: np.stack([fold(sketches[i], count) for i in order[first:]]) for count, first in firsts.items()}
    group, found = np.arange(len(size)), []
    ends = np.searchsorted(size * percent, size * 100, "right")
    limits = [*list(firsts.values())[1:], len(size)]
    for (count, first), limit in zip(firsts.items(), limits):
        low, own = first, folded[count]
        while low < limit:
            # rows that are compared at once
            high = min(limit, low + max(1, AT_ONCE // (count * max(1, int(ends[low]) - low))))
            row, other = np.arange(low, high), np.arange(low + 1, max(low + 1, int(ends[high - 1])))
            open_ = (other > row[:, None]) & (other < ends[row, None]) & (group[other] != group[row, None])
            if crossed:
                open_ &= side[other] != side[row, None]
            row, other, low = row[open_.any(axis=1)], other[open_.any(axis=0)], high
            if not len(row):
                continue
            apart = np.bitwise_count(own[row - first][:, None] ^ own[other - first]).sum(axis=2, dtype=np.int64)
            near = apart * (100 + percent) <= (size[other] + size[row, None]) * (100 - percent)
            near &= (other > row[:, None]) & (other < ends[row, None])
            if crossed:
                near &= side[other] != side[row, None]
            for at in np.flatnonzero(near.any(axis=1)).tolist():
                i, met = int(row[at]), other[near[at]]
                for j in met[group[met] != group[i]].tolist():
                    if group[j] != group[i] and (sets is None or _similar(sets[order[i]], sets[order[j]], percent)):
                        found.append((int(order[i]), int(order[j])))
                        group[group == group[j]] = group[i]
    return found


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int((b[at] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _links(docs: DataFrame, chosen: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): links among the chosen texts (doc_id, component), enough to connect them."""
    small = chosen.count()
    sizes = chosen.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    wanted = chosen.select("doc_id", "one", "two")
    texts = docs.select("doc_id", "text").join(
        F.broadcast(wanted.select("doc_id")) if small <= BROADCAST_ROWS else wanted.select("doc_id"),
        "doc_id", "left_semi",
    )

    def sets(batches):
        for batch in batches:
            done = 0
            for found in _sets(batch, width):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(found)), *map(pa.array, Sets(found).marks()),
                     pa.array([s.tobytes() for s in found], pa.binary())],
                    ["doc_id", "one", "two", "shingles"],
                )
                done += len(found)

    held = texts.mapInArrow(sets, "doc_id long, one long, two long, shingles binary")
    rows = held.join(chosen.join(sizes, "component"), ["doc_id", "one", "two"]).dropDuplicates(["doc_id", "one", "two"])
    blocks = _in_blocks(rows, "component", "doc_id", ["shingles"], small // BLOCK)

    def described(frame: pd.DataFrame):
        def of(part: slice):
            found = [np.frombuffer(b, np.uint64) for b in frame["shingles"].iloc[part]]
            size = np.array([len(s) for s in found])
            words_ = differing(2 * int(size.max()), percent) // 16 + 4
            return size, [sketch(s, words_, 0) for s in found], found

        return of

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        return _connected(frame, "component", "doc_id", described, percent)

    return blocks.applyInPandas(compare, "a long, b long")


def similar_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Texts are lower-cased over A-Z and cut at ASCII white space; two are linked if the shingles
    that both hold are at least ``percent`` of those that either holds. ``component_id`` is
    the smallest doc_id reachable by links, the own one without links, NULL for a NULL doc_id.
    NULL texts and those without words hold nothing and are linked with nothing. Rows that share a
    doc_id count as one document. Other columns of ``docs`` are not looked at.
    """
    described = stored(_described(docs, width, percent), "shingle-sets")
    real = described.where("n > 0 AND doc_id IS NOT NULL")
    tied = _ties(_entries(docs, width, percent), described, percent)
    candidates = components(tied)
    classes = real.groupBy("n", "one", "two").agg(F.min("doc_id").alias("doc_id"))
    chosen = stored(
        classes.join(candidates, classes["one"] == candidates["node"])
        .select("doc_id", "n", "one", "two", "component"), "candidates",
    )
    links = stored(_links(docs, chosen, width, percent), "verified-links")
    same = real.groupBy("doc_id").agg(F.min(F.struct("n", "one", "two")).alias("x"), F.max(F.struct("n", "one", "two")).alias("y")).where("x <> y")
    firsts = with_group(
        real.select("doc_id", "n", "one", "two"), ["n", "one", "two"], ["doc_id"],
        {"_part": F.min("doc_id")}, {"first": F.min("_part")},
    )
    # rows with one doc_id and several texts tie the groups of these texts together
    shared_ids = firsts.join(same.select("doc_id"), "doc_id").where("doc_id <> first").select(
        F.col("doc_id").alias("a"), F.col("first").alias("b")
    )
    groups = components(links.unionByName(shared_ids))
    found = (
        firsts.join(groups, F.coalesce("first", "doc_id") == groups["node"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "first").alias("component_id"))
    )
    rest = described.where("n = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return found.unionByName(rest)


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows whose doc_id is the smallest of their group, and those without a doc_id."""
    groups = similar_groups(docs.select("doc_id", "text"), width, percent)
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    small = gone.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti")


@query("op6_jaccard_join", r"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE
               list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s
        FROM texts
    ), shingles AS (
        SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
    ), links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b USING (x) WHERE a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
    ), reached AS (
        SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
    )
    SELECT doc_id, len(s) AS n_shingles,
           least(doc_id, coalesce((SELECT min(b) FROM reached WHERE a = doc_id), doc_id)) AS component_id
    FROM sets
""")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 90)
