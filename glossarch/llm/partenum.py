"""Problem 4: near-duplicates with small edits, by PartEnum signatures.

A text is the set of its runs of ``words`` words. With similarity (shared over all) of at least g, two sets of sizes a and b share at
least ceil(g * max(a, b)) elements. Take any order of all elements. The first t shared elements in it are among the first
a - ceil(g * a) + t of either set. The domain of elements is cut into t - 1 parts by hash, so two of those t lie in one part: each
set enumerates, part by part, the pairs of its first elements, and sufficiently similar sets have a pair in common. Sizes are
grouped in bands with their own number of parts; a set signs in its own band and, if it may have a smaller partner
there, in the band below. In the lowest band, of very small sets, the single elements are the signatures.

Any order makes this exact; a good one puts rare elements first. It comes from counts over all distinct sets: sets are packed
in chunks, a chunk sends each bucket of the domain its distinct elements once and gets their counts back, so that neither tasks nor driver
hold more than one bucket or chunk, whatever the size of the collection. An element counted once is in no other set and signs nothing.
If the rarest shared element is counted at most ``RARE`` times, it is among the first a - ceil(g * a) + 1 of both sets and
signs alone; otherwise all shared elements are counted more often, and pairs of these are enumerated only.

A signature of more than ``HOT`` sets is not compared by all pairs of them. Sets under such signatures sign again, by each common element of their first
a - ceil(g * a) + 1 (the first shared one is among these); what is hot even then is compared block by block, each block pair in a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarch.llm.shingles import WordHashes, mixed, runs, words_of
from glossarch.operators.upsert import latest_rows
from glossarch.plans.scratch import written

#: least set size of each band, and the parts its domain is cut into
BANDS = [(1, 0), (10, 4), (40, 10), (160, 40), (640, 160), (2560, 640), (10240, 2560), (40960, 10240), (163840, 40960), (655360, 163840), (2621440, 655360)]
#: elements of a chunk of sets, of a bucket of the domain, and of the sets whose signatures one task compares, aimed at
CHUNK, BUCKET, TASK = 1 << 18, 1 << 19, 1 << 19
#: count up to which an element signs alone (at most ``HOT``); sets of one signature compared at once; of a hot one, sets in a block
RARE, HOT, SIDE = 48, 2048, 2048
#: bytes of a block of a bit table; classes a task remembers having sent
BLOCK, MET_ROOM = 1 << 12, 1 << 20


def _elements(texts: list[str | None], known: WordHashes, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each text, sorted within it; the text of each; the number of each text's elements."""
    h, owner, _ = runs(*words_of([t.lower() if t else t for t in texts], known), words)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[first], owner[first]
    return h, owner, np.bincount(owner, minlength=len(texts))


def sets_of(df: DataFrame, kind: int, key: str, text: str, words: int = 3) -> DataFrame:
    """``kind, key, text, class, size, m0..m3`` of each text with at least ``words`` words; sets of different kind never meet.

    Characters are taken as stored but lower-cased. ``class`` names the set (64 bits, seeded by kind), ``m0..m3`` are a
    256-bit map of it in which each element turns one bit. Null, empty and shorter texts have no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                h, owner, size = _elements(part.column("text").to_pylist(), known, words)
                has = np.flatnonzero(size)
                bits = np.bincount(owner * 256 + (h >> np.uint64(56)).astype(np.int64), minlength=part.num_rows * 256) & 1
                maps = np.packbits(bits.reshape(-1, 256).astype(np.uint8)[has], axis=1).view(np.int64)
                ends = np.cumsum(size)
                names = [xxhash.xxh3_64_intdigest(h[ends[i] - size[i] : ends[i]].tobytes(), seed=kind) for i in has]
                take = pa.array(has)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(has), kind, np.int32)), part.column("key").take(take), part.column("text").take(take)]
                    + [pa.array(np.array(names, np.uint64).astype(np.int64)), pa.array(size[has].astype(np.int32)), *(pa.array(np.ascontiguousarray(maps[:, j])) for j in range(4))],
                    ["kind", "key", "text", "class", "size", "m0", "m1", "m2", "m3"],
                )

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "kind int, key string, text string, class bigint, size int, m0 bigint, m1 bigint, m2 bigint, m3 bigint")


def _keys(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of an element and its 32 bits there, in one number. Elements that share it are counted as one, which only overestimates."""
    return (h >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | (h & np.uint64(0xFFFFFFFF))


def _chunks(sets: DataFrame, chunks: int) -> DataFrame:
    """``chunk`` and what the signatures of a set need, brought together by chunk. Of the copies of one set a task sends about one."""
    folded = [F.col(f"m{j}").bitwiseXOR(F.col(f"m{j + 2}")).alias(f"m{j}") for j in range(2)]
    rows = sets.select(F.pmod("class", F.lit(chunks)).alias("chunk"), "class", "kind", "size", *folded, "text")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            new = [i for i, n in enumerate(batch.column("class").to_pylist()) if not (n in met or met.add(n))]
            if len(met) > MET_ROOM:
                met.clear()
            yield batch.take(pa.array(new, pa.int32()))

    return rows.mapInArrow(once, "chunk bigint, class bigint, kind int, size int, m0 bigint, m1 bigint, text string").repartition("chunk")


def _distinct(group: pa.Table) -> pa.Table:
    """The sets of a chunk, each once, in the order of their names."""
    return group.take(pa.array(np.unique(group["class"].to_numpy(), return_index=True)[1]))


def _seen(chunks: DataFrame, words: int, buckets: int) -> DataFrame:
    """``chunk, bucket, seen``: for the distinct elements of a chunk in a bucket, in order, the sets of the whole collection that hold them (at most 255)."""

    def ask(group: pa.Table) -> pa.Table:
        h, _, _ = _elements(_distinct(group)["text"].to_pylist(), WordHashes(), words)
        keys, n = np.unique(_keys(h, buckets), return_counts=True)
        n, lows, bucket = np.minimum(n, 255).astype(np.uint8), keys.astype(np.uint32), (keys >> np.uint64(32)).astype(np.int32)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(starts[1:], len(keys)).astype(int)
        raw = [pa.array([x[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()) for x in (lows, n)]
        return pa.table([pa.array([group["chunk"][0].as_py()] * len(starts), pa.int64()), bucket[starts], *raw], ["chunk", "bucket", "elements", "counts"])

    def count(group: pa.Table) -> pa.Table:
        lows = [np.frombuffer(x, np.uint32) for x in group["elements"].to_pylist()]
        each = np.concatenate([np.frombuffer(x, np.uint8) for x in group["counts"].to_pylist()])
        _, at = np.unique(np.concatenate(lows), return_inverse=True)
        total = np.minimum(np.bincount(at, each), 255).astype(np.uint8)[at]
        ends = np.cumsum([len(x) for x in lows])
        return pa.table([group["chunk"], group["bucket"], pa.array([total[e - len(x) : e].tobytes() for x, e in zip(lows, ends)], pa.binary())], ["chunk", "bucket", "seen"])

    asked = chunks.groupBy("chunk").applyInArrow(ask, "chunk bigint, bucket int, elements binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(count, "chunk bigint, bucket int, seen binary")


def signatures(h: np.ndarray, owner: np.ndarray, size: np.ndarray, seen: np.ndarray, least: Fraction, rare: int, alone: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a batch of sets (elements ``h`` of set ``owner``, counted ``seen`` times) and the set of each.

    ``alone``: those by single elements only, for elements counted more than ``rare`` times.
    """
    p, q = least.numerator, least.denominator
    spread = mixed(h, 1)
    order = np.lexsort((h, spread, seen, owner))
    h, owner, seen, spread = h[order], owner[order], seen[order], spread[order]
    a = size[owner]
    place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
    spare = a - -(-(p * a) // q)  # elements that need not be shared
    if alone:
        use = (place <= spare) & (seen > max(rare, 1))
        return mixed(h[use], len(BANDS) + 1), owner[use]
    use = (place <= spare) & (seen > 1) & (seen <= rare)
    out, whose = [mixed(h[use], len(BANDS))], [owner[use]]
    for band, (low, parts) in enumerate(BANDS):
        high = BANDS[band + 1][0] - 1 if band + 1 < len(BANDS) else np.inf
        # own band, or one above with a possible partner of at most ``high`` elements
        use = (a >= low) & (p * a <= q * high) & (place <= spare + parts) & (seen > max(rare, 1))
        if not use.any():
            continue
        e, o = h[use], owner[use]
        if not parts:
            out.append(mixed(e, band))
            whose.append(o)
            continue
        part = (spread[use] % np.uint64(parts)).astype(np.int64)
        by = np.lexsort((part, o))  # stable: within a part the order of the elements stays
        e, o, part = e[by], o[by], part[by]
        step = 1
        while step < len(e):
            same = np.flatnonzero((o[step:] == o[:-step]) & (part[step:] == part[:-step]))
            if not len(same):
                break
            out.append(mixed(mixed(e[same], e[same + step]), band))
            whose.append(o[same])
            step += 1
    return np.concatenate(out), np.concatenate(whose).astype(np.int64)


SIGNED = "signature bigint, class bigint, size int, m0 bigint, m1 bigint"


def _signed(sets: DataFrame, total: int, least: Fraction, words: int, alone: bool) -> DataFrame:
    """``signature, class, size, m0, m1`` of all sets; ``alone``: of single elements only."""
    buckets = -(-total // BUCKET) or 1
    chunks = _chunks(sets, -(-total // CHUNK) or 1)

    def sign(group: pa.Table, counts: pa.Table) -> pa.Table:
        rows = _distinct(group)
        h, owner, size = _elements(rows["text"].to_pylist(), WordHashes(), words)
        by, replies = np.argsort(counts["bucket"].to_numpy()), counts["seen"].to_pylist()
        seen = np.concatenate([np.empty(0, np.uint8), *(np.frombuffer(replies[i], np.uint8) for i in by)])
        _, at = np.unique(_keys(h, buckets), return_inverse=True)
        sig, whose = signatures(h, owner, size, seen[at], least, 0 if alone else min(RARE, HOT), alone)
        sig = mixed(sig, rows["kind"].to_numpy()[whose].astype(np.uint64)).astype(np.int64)
        return pa.table([pa.array(sig), *(pa.array(rows[c].to_numpy()[whose]) for c in ("class", "size", "m0", "m1"))], ["signature", "class", "size", "m0", "m1"])

    # the exchange of the texts is made once and read by both
    return chunks.groupBy("chunk").cogroup(_seen(chunks, words, buckets).groupBy("chunk")).applyInArrow(sign, SIGNED)


class _Near:
    """Whether two sets may be similar, by sizes and folded bit maps: shared >= least * (size - shared) <=> differing <= (1 - least) / (1 + least) * size, and differing bits are differing elements."""

    def __init__(self, least: Fraction):
        self.p, self.q = least.numerator, least.denominator

    def __call__(self, c, s, m, i, j) -> np.ndarray:
        one, two = s[i], s[j]
        bits = sum(np.bitwise_count((x[i] ^ x[j]).view(np.uint64)).astype(np.int64) for x in m) * (self.q + self.p)
        return (bits <= (self.q - self.p) * (one + two)) & (self.p * one <= self.q * two) & (self.p * two <= self.q * one) & (c[i] != c[j])


MET = "signature bigint, class_a bigint, class_b bigint, size_a int, size_b int, m0 bigint, m1 bigint"
_MET = ["signature", "class_a", "class_b", "size_a", "size_b", "m0", "m1"]


def _found(c: np.ndarray, s: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[pa.Array]:
    """Columns of ``MET`` for the pairs of places ``i, j``, each pair once, the smaller class first."""
    i, j = np.where(c[i] < c[j], i, j), np.where(c[i] < c[j], j, i)
    pairs = np.stack([c[i], c[j]], 1)
    _, at = np.unique(np.ascontiguousarray(pairs).view([("a", np.int64), ("b", np.int64)]).ravel(), return_index=True) if len(i) else (None, i)
    i, j = i[at], j[at]
    none = pa.nulls(len(i), pa.int64())
    return [none, pa.array(c[i]), pa.array(c[j]), pa.array(s[i].astype(np.int32)), pa.array(s[j].astype(np.int32)), none, none]


def _met(signed: DataFrame, least: Fraction, tasks: int) -> DataFrame:
    """``MET`` rows: candidates (null ``signature``), and the sets (as ``class_a, size_a``) of signatures that are hot.

    Tasks get whole signatures and read them in a stream, at most ``HOT`` sets of one are held.
    """
    near = _Near(least)

    def pairs(sig, c, s, m) -> pa.RecordBatch:
        live, step, out = np.arange(len(sig)), 1, [(np.empty(0, np.int64),) * 2]
        while True:
            live = live[live + step < len(sig)]
            live = live[sig[live] == sig[live + step]]
            if not len(live):
                break
            ok = live[near(c, s, m, live, live + step)]
            out.append((ok, ok + step))
            step += 1
        return pa.RecordBatch.from_arrays(_found(c, s, *(np.concatenate(x) for x in zip(*out))), _MET)

    def hot(sig, c, s, m) -> pa.RecordBatch:
        none = pa.nulls(len(sig), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(c), none, pa.array(s.astype(np.int32)), none.cast(pa.int32()), pa.array(m[0]), pa.array(m[1])], _MET)

    def part(cols, keep):
        sig, c, s, m = cols
        return sig[keep], c[keep], s[keep], [x[keep] for x in m]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, burning = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 1 << 16):
                b = batch.slice(lo, 1 << 16)
                cols = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy().astype(np.int64), [b.column(3).to_numpy(), b.column(4).to_numpy()]
                if burning is not None:  # the rest of a hot signature
                    same = cols[0] == burning
                    if same.any():
                        yield hot(*part(cols, same))
                    cols = part(cols, ~same)
                if held is not None:
                    cols = *(np.concatenate(x) for x in zip(held[:3], cols[:3])), [np.concatenate(x) for x in zip(held[3], cols[3])]
                sig = cols[0]
                if not len(sig):
                    held = None
                    continue
                starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
                length = np.diff(np.append(starts, len(sig)))
                many = np.repeat(length > HOT, length)
                if many.any():
                    yield hot(*part(cols, many))
                last = np.arange(len(sig)) >= starts[-1]
                burning = sig[-1] if length[-1] > HOT else None
                held = part(cols, last & ~many)
                yield pairs(*part(cols, ~last & ~many))
        if held is not None and len(held[0]):
            yield pairs(*held)

    return signed.repartition(tasks, "signature").sortWithinPartitions("signature").mapInArrow(run, MET)


def _blocks(hot: DataFrame, least: Fraction) -> DataFrame:
    """Candidates among all sets of each hot signature: sets are spread over blocks of about ``SIDE``, each two blocks meet in a group."""
    near = _Near(least)
    rows = hot.select("signature", F.col("class_a").alias("class"), F.col("size_a").alias("size"), "m0", "m1").distinct()
    many = rows.groupBy("signature").agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias("blocks"))
    rows = rows.join(many, "signature").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("signature", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "class", "size", "m0", "m1")

    def compare(group: pa.Table) -> pa.Table:
        c, s = group["class"].to_numpy(), group["size"].to_numpy().astype(np.int64)
        m, block = [group["m0"].to_numpy(), group["m1"].to_numpy()], group["block"].to_numpy()
        one = np.flatnonzero(block == group["lo"][0].as_py())
        two = np.flatnonzero(block == group["hi"][0].as_py())
        out = [(np.empty(0, np.int64),) * 2]
        for i in one:
            j = two if group["lo"][0] != group["hi"][0] else two[two > i]
            j = j[near(c, s, m, i, j)]
            out.append((np.full(len(j), i), j))
        return pa.Table.from_arrays(_found(c, s, *(np.concatenate(x) for x in zip(*out))), _MET)

    return rows.groupBy("signature", "lo", "hi").applyInArrow(compare, MET)


def _candidates(sets: DataFrame, least: Fraction, words: int) -> DataFrame:
    """``class_a, class_b`` (class_a < class_b): all pairs that share a signature and whose folded maps are near."""

    def meet(some: DataFrame, alone: bool) -> tuple[DataFrame, DataFrame]:
        total = some.agg(F.sum("size")).first()[0] or 0
        tasks = max(-(-total // TASK), int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        met = written(_met(_signed(some, total, least, words, alone), least, tasks), "met")
        return met.filter("signature is null").select("class_a", "class_b"), met.filter("signature is not null")

    found, hot = meet(sets, False)
    if not hot.isEmpty():
        among = sets.sparkSession.sparkContext.broadcast(_marked(hot.select("class_a").distinct()))

        def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(_holds(among.value, batch.column("class").to_numpy())))

        more, hot = meet(written(sets.mapInArrow(members, sets.schema), "hot"), True)
        found = found.union(more).union(_blocks(hot, least).select("class_a", "class_b"))
    return found.distinct()


def _map(elements: np.ndarray) -> bytes:
    """A bit map in proportion to the set in which each element turns one bit."""
    bits = 1 << max(8, int(2 * len(elements) - 1).bit_length())
    odd = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _apart(x: bytes, y: bytes) -> int:
    """Differing bits of two maps, the longer folded to the shorter: never more than there are differing elements."""
    one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(one) < len(two):
        one, two = two, one
    while len(one) > len(two):
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    return int(np.bitwise_count(one ^ two).sum())


def _marked(classes: DataFrame) -> np.ndarray:
    """A bit table of classes, by value modulo its size: 16 bits a class, at most 16 MB. Built by the tasks, put together block by block."""
    size = 1 << int(np.clip(np.log2(16 * max(classes.count(), 1)), 16, 27))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size // 8, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy().astype(np.uint64) % np.uint64(size)
            np.bitwise_or.at(table, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        blocks = table.reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([blocks[i].tobytes() for i in some], pa.binary())], ["block", "bits"])

    def add(tables: pa.Table) -> pa.Table:
        raw = np.stack([np.frombuffer(r, np.uint8) for r in tables["bits"].to_pylist()])
        return pa.table({"block": tables["block"][:1], "bits": pa.array([np.bitwise_or.reduce(raw, 0).tobytes()], pa.binary())})

    out = np.zeros((size // 8 // BLOCK, BLOCK), np.uint8)
    schema = "block int, bits binary"
    for row in classes.mapInArrow(mark, schema).groupBy("block").applyInArrow(add, schema).toArrow().to_pylist():
        out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _holds(table: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether a class is in a bit table, or shares its bit with one that is."""
    at = classes.astype(np.uint64) % np.uint64(len(table) * 8)
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def similar_classes(sets: DataFrame, least: Fraction, words: int = 3) -> DataFrame:
    """``class_a, class_b, shared, either`` (class_a < class_b): all pairs of different sets with similarity of at least ``least``.

    ``sets`` is a written table of ``sets_of``. Exact up to collisions of 64-bit hashes.
    """
    p, q = least.numerator, least.denominator
    if not Fraction(1, 2) <= least <= 1:
        raise ValueError("the bands hold for similarities from one half to one")

    def may_be(words: int):
        bits = sum(F.bit_count(F.col(f"m{j}_a").bitwiseXOR(F.col(f"m{j}_b"))) for j in range(words))
        return (q + p) * bits <= (q - p) * (F.col("size_a") + F.col("size_b"))

    near = _candidates(sets, least, words)
    # the few that are left meet the whole maps, before texts are moved
    maps = sets.groupBy("class").agg(*(F.max(c).alias(c) for c in ("kind", "size", "m0", "m1", "m2", "m3")))
    for side in "ab":
        near = near.join(maps.select(*(F.col(c).alias(f"{c}_{side}") for c in maps.columns)), f"class_{side}")
    near = written(near.filter((F.col("kind_a") == F.col("kind_b")) & may_be(4)).select("class_a", "class_b", "size_a", "size_b"), "candidates")
    # of the texts, only those whose class is (or shares a bit with) one of these give their elements
    bits = sets.sparkSession.sparkContext.broadcast(_marked(near.select(F.col("class_a").alias("class")).union(near.select("class_b"))))

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = WordHashes(), bits.value
        for batch in batches:
            part = batch.filter(pa.array(_holds(table, batch.column("class").to_numpy())))
            for lo in range(0, part.num_rows, 4096):
                some = part.slice(lo, 4096)
                h, _, size = _elements(some.column("text").to_pylist(), known, words)
                lists = [h[e - n : e] for n, e in zip(size, np.cumsum(size))]
                maps = pa.array([_map(x) for x in lists], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column("class"), maps, pa.array([x.tobytes() for x in lists], pa.binary())], ["class", "map", "elements"])

    some = sets.select("class", "text").mapInArrow(elements, "class bigint, map binary, elements binary")
    full = written(latest_rows(some, "class", [F.col("class")]), "elements")

    def both(pairs: DataFrame, column: str) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(full.select(F.col("class").alias(f"class_{side}"), F.col(column).alias(side)), f"class_{side}")
        return pairs

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column("size_a").to_numpy().astype(np.int64), batch.column("size_b").to_numpy().astype(np.int64)
            differing = np.array([_apart(x, y) for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())], np.int64)
            keep = pa.array((q + p) * differing <= (q - p) * (one + two))
            yield pa.RecordBatch.from_arrays([batch.column("class_a").filter(keep), batch.column("class_b").filter(keep)], ["class_a", "class_b"])

    pairs = both(near, "map").select("class_a", "class_b", "size_a", "size_b", "a", "b").mapInArrow(alike, "class_a bigint, class_b bigint")
    pairs = both(pairs, "elements")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            one, two = np.array([len(x) // 8 for x in xs], np.int64), np.array([len(y) // 8 for y in ys], np.int64)
            both = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(xs, ys)]
            shared = np.array(both, np.int64)
            either = one + two - shared
            keep = np.flatnonzero(q * shared >= p * either)
            take = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column("class_a").take(take), batch.column("class_b").take(take), pa.array(shared[keep]), pa.array(either[keep])], ["class_a", "class_b", "shared", "either"])

    return pairs.select("class_a", "class_b", "a", "b").mapInArrow(verify, "class_a bigint, class_b bigint, shared bigint, either bigint")


def record_pairs(sets: DataFrame, similar: DataFrame) -> DataFrame:
    """``rec_a, rec_b``: pairs of keys of one kind whose sets are equal or in ``similar``; smaller key first."""
    a = sets.select(F.col("class").alias("class_a"), F.col("key").alias("ka"))
    b = sets.select(F.col("class").alias("class_b"), F.col("key").alias("kb"))
    equal = sets.groupBy("class").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("class").alias("class_a"))
    same = equal.join(a, "class_a").join(b.withColumnRenamed("class_b", "class_a"), "class_a").filter("ka < kb").select(F.col("ka").alias("rec_a"), F.col("kb").alias("rec_b"))
    other = similar.select("class_a", "class_b").join(a, "class_a").join(b, "class_b")
    other = other.select(F.least("ka", "kb").alias("rec_a"), F.greatest("ka", "kb").alias("rec_b"))
    return same.unionByName(other)


def groups(sets: DataFrame, similar: DataFrame) -> DataFrame:
    """``kind, key, class_id, links, group_id``: one row per record; ``links`` counts the other classes its class is similar to,
    ``group_id`` is the smallest class of the connected group (classes named by their smallest key)."""
    pairs = written(similar.select("class_a", "class_b"), "links")
    both = pairs.union(pairs.select("class_b", "class_a"))
    links = both.groupBy(F.col("class_a").alias("class")).agg(F.count(F.lit(1)).alias("links"))
    top = connected(pairs)
    names = sets.groupBy("class").agg(F.min("key").alias("class_id"))
    label = names.join(links, "class", "left").join(top, "class", "left").withColumn("top", F.coalesce("top", "class"))
    label = written(label, "labels")
    heads = label.groupBy("top").agg(F.min("class_id").alias("group_id"))
    named = label.join(heads, "top").select("class", "class_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"), "group_id")
    return sets.select("kind", "key", "class").join(named, "class").drop("class")


def connected(pairs: DataFrame) -> DataFrame:
    """``class, top``: the smallest node of each node's component, by alternating large-star and small-star steps.

    Each round is written, so a lost executor repeats one round; the rounds needed grow with the logarithm of the size of a component.
    """
    edges = written(pairs.select(F.col("class_a").alias("u"), F.col("class_b").alias("v")).filter("u <> v").distinct(), "edges")
    total = None
    while True:
        sides = edges.union(edges.select("v", "u"))
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = sides.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        after = written(small.filter("u <> v").distinct(), "edges")
        now = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if total == tuple(now):
            break
        total, edges = tuple(now), after
    stars = edges.groupBy(F.col("u").alias("class")).agg(F.min("v").alias("top"))
    return stars.union(edges.select(F.col("v").alias("class"), F.col("v").alias("top")).distinct().join(stars, "class", "left_anti"))
