"""MinHash near-dedup: banded minima of universal hashes, signature and full-set confirmation, alternating stars.

A document's set holds its distinct five-word shingles as 64-bit hashes; two documents are linked if their sets have a
Jaccard similarity of at least 0.75. Documents with equal sets form a class, named by a hash of the set, and classes are
what is compared, so that copies cost one row each however many there are.

No bucket of a band is ever expanded into pairs as long as its members belong together: every member is first paired
with the bucket's smallest member only, and confirmed links are merged into components. Afterwards only members of one
bucket that lie in different components are compared with each other, in blocks, which finds all links between
components that share a bucket. With 32 bands of 4 minima a pair of similarity 0.75 shares no bucket with probability 5e-6.

Defined cases: words are separated by ASCII white space, A-Z are lower-cased. Fewer than five words: the whole
sequence is one shingle. No words or a null text: the empty set, linked with nothing. Rows that repeat a doc_id are
documents with one name: each gets a row, and all have the component of the smallest doc_id that any of them reaches.
A null doc_id is a document that is linked with nothing and not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import fresh, stored, table

WORDS = 5
BANDS, ROWS = 32, 4
MINIMUM = (75, 100)
#: Pairs whose signatures agree in fewer places are not confirmed on sets: 5.7 standard deviations below 0.75.
LEAST_AGREEING = 68
WORDS_KEPT = 1 << 19
#: Hashes of a set that are compared inside buckets, and members of a bucket that are compared in one task. Sets that
#: are no larger are compared whole.
BOTTOM, BLOCK = 1024, 1024
SLICE = 256

_random = np.random.default_rng(20240607)
MULTIPLY = _random.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
ADD = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
PLACE = _random.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)


class WordHashes(dict):
    """Hashes of words, looked up in bulk. Forgets all when it gets large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of the five-word shingles of a text."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(words) < WORDS:
        return mixed(np.array([(h * PLACE[: len(h)]).sum(dtype=np.uint64) + np.uint64(len(h))], np.uint64))
    n = len(h) - WORDS + 1
    return np.unique(mixed(sum(h[k : n + k] * PLACE[k] for k in range(WORDS))))


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """The minima of BANDS * ROWS universal hashes, 32 bits each. Long sets are taken in slices."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(shingle_set), SLICE):
        part = shingle_set[at : at + SLICE]
        values = (MULTIPLY[:, None] * part[None, :] + ADD[:, None]) >> np.uint64(32)
        least = np.minimum(least, values.min(1).astype(np.uint32))
    return least


def bands(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    return mixed((rows * PLACE[:ROWS]).sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def class_name(shingle_set: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(shingle_set.tobytes()) - (1 << 63) if len(shingle_set) else None


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class, signature of each row of docs (doc_id, text)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, names, signatures = [], [], []
            for text in batch.column(1):
                own = shingles(text.as_py(), hashes)
                sizes.append(len(own))
                names.append(class_name(own))
                signatures.append(signature(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "class", "signature"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        sketch, "doc_id long, n_shingles long, class long, signature binary"
    )


def buckets(classes: DataFrame) -> DataFrame:
    """bucket, class: the BANDS buckets of each class."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = [bands(np.frombuffer(s, np.uint32)) for s in batch.column(1).to_pylist()]
                names = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(names)], ["bucket", "class"])

    return classes.select("class", "signature").mapInArrow(cut, "bucket long, class long")


def agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of classes (a, b) whose signatures agree often enough."""
    left, right = classes.select("class", "signature").toDF("a", "signature_a"), classes.select("class", "signature").toDF("b", "signature_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, BANDS * ROWS) for k in (2, 3))
                keep = (a == b).sum(1) >= LEAST_AGREEING
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "signature_a", "signature_b")
    return both.mapInArrow(compare, "a long, b long")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs of classes (a, b) whose full shingle sets are similar enough. Only texts of classes in pairs are moved."""
    named = stored(pairs)
    own = stored(sets_of(named.select(F.explode(F.array("a", "b")).alias("class")).distinct(), classes, docs))
    both = named.join(own.toDF("a", "set_a"), "a").join(own.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(MINIMUM[1] * common >= MINIMUM[0] * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long").distinct()


def sets_of(members: DataFrame, classes: DataFrame, docs: DataFrame, most: int | None = None) -> DataFrame:
    """class, own: the smallest ``most`` hashes, or all, of the shingle sets of the classes in ``members`` (class). Only
    their texts are moved."""
    chosen = classes.join(members, "class", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).join(chosen, "doc_id", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            own = [shingles(t.as_py(), hashes) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_name(x) for x in own], pa.int64()), pa.array([x[:most].tobytes() for x in own], pa.binary())], ["class", "own"]
            )

    return texts.mapInArrow(sets, "class long, own binary")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component: the smallest node that each node of ``edges`` (a, b) reaches, by alternating large and small stars.
    A smallest node itself has no row.

    Every half round is one minimum per node and one join on the node. Minima are stored first, so that the join is one
    of two tables dealt by key, whose large partitions adaptive execution can split.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(max_rounds):
        # Large star: every larger neighbour of a node is tied to the node's smallest neighbour.
        both = edges.union(edges.select("v", "u"))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = stored(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # Small star: a node and its smaller neighbours are tied to the smallest of them.
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        tied = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(tied.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        before = state
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of ``docs`` (doc_id, text)."""
    drawn = stored(sketches(docs))
    whole = drawn.where("class is not null and doc_id is not null")
    of_class = [F.first(c).alias(c) for c in ("n_shingles", "signature")]
    classes = stored(whole.groupBy("class").agg(F.min("doc_id").alias("rep"), *of_class))
    dealt = buckets(classes)
    hubs = stored(dealt.groupBy("bucket").agg(F.min("class").alias("hub"), F.max("class").alias("last")).where("hub <> last"))
    full = stored(dealt.join(hubs.select("bucket", "hub"), "bucket"))
    spokes = full.where("class <> hub").select(F.col("hub").alias("a"), F.col("class").alias("b")).distinct()
    links = stored(confirmed(agreeing(spokes, classes), classes, docs).union(same_name(whole)))
    groups = stored(components(links))
    grouped = stored(
        full.join(groups, full["class"] == groups["node"], "left").select("bucket", "class", F.coalesce("component", "class").alias("component"))
    )
    split = grouped.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("members"))
    rest = grouped.join(stored(split.where("x <> y").select("bucket", "members")), "bucket")
    bottoms = stored(sets_of(rest.select("class").distinct(), classes, docs, BOTTOM).dropDuplicates(["class"]).toDF("class", "bottom"))
    rest = rest.join(classes.select("class", "n_shingles", "signature"), "class").join(bottoms, "class")
    more = stored(confirmed(apart(rest).distinct(), classes, docs))
    if not more.isEmpty():
        groups = stored(components(links.union(more)))
    ends = classes.join(groups, classes["class"] == groups["node"], "left").select("class", "rep", F.coalesce("component", "class").alias("component"))
    smallest = ends.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = stored(ends.join(smallest, "component").select(F.col("class").alias("of"), "component_id"))
    joined = drawn.select("doc_id", "n_shingles", "class").join(named, F.col("class") == F.col("of"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def same_name(whole: DataFrame) -> DataFrame:
    """Pairs of classes that share a doc_id."""
    several = whole.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a <> z").select("doc_id", "a")
    return whole.join(several, "doc_id").select("a", F.col("class").alias("b")).where("a <> b").distinct()


def apart(rest: DataFrame) -> DataFrame:
    """Pairs (a, b) of one bucket but different components that may be linked.

    The members of a bucket are dealt into blocks, and each pair of blocks is compared in one task as matrices, so that
    a bucket of any size is split and only what may be a link is returned. A pair is looked at in the first band that it
    shares. Its similarity is computed from both sets, or estimated from the smallest hashes of sets larger than BOTTOM;
    a pair that is surely linked is returned only if it joins what nothing returned from these blocks has joined yet.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class"), blocks).cast("int")
    dealt = rest.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    keys = [F.col("bucket"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
    dealt = dealt.select(*keys, "own", "class", "component", "n_shingles", "signature", "bottom")
    dealt = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 3):
            found = between(rows)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of sorted batches by their first ``keys`` columns."""
    open_rows: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)], 1)
        cuts = [0, *(np.flatnonzero((columns[1:] != columns[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if low == high:
                continue
            key = tuple(columns[low].tolist())
            if open_rows and key != last:
                yield pa.Table.from_batches(open_rows)
                open_rows = []
            last = key
            open_rows.append(batch.slice(low, high - low))
    if open_rows:
        yield pa.Table.from_batches(open_rows)


def between(rows: pa.Table) -> list[tuple[int, int]]:
    """The pairs of two blocks of a bucket, or of one block, that may be links between components."""
    i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    bucket, own = rows.column("bucket")[0].as_py(), rows.column("own").to_numpy()
    names, component = rows.column("class").to_numpy(), rows.column("component").to_numpy()
    sizes, bottoms = rows.column("n_shingles").to_numpy(), [np.frombuffer(b.as_py(), np.uint64) for b in rows.column("bottom")]
    signatures = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(len(own), BANDS * ROWS)
    keys = np.stack([bands(s) for s in signatures])
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    sure, open_pairs = [], []
    for x in left:
        y = right[right > x] if i == j else right
        y = y[component[y] != component[x]]
        if not len(y):
            continue
        y = y[(signatures[y] == signatures[x]).sum(1) >= LEAST_AGREEING]
        shared = keys[y] == keys[x]
        y = y[keys[x][shared.argmax(1)] == bucket] if len(y) else y
        for other in y.tolist():
            low, high = likely(bottoms[x], bottoms[other], int(sizes[x]), int(sizes[other]))
            if low >= 0.75:
                sure.append((int(x), other))
            elif high >= 0.75:
                open_pairs.append((int(x), other))
    top: dict[int, int] = {}

    def root(c: int) -> int:
        while top.get(c, c) != c:
            c = top[c]
        return c

    out = []
    for x, y in sure:
        a, b = root(int(component[x])), root(int(component[y]))
        if a != b:
            top[max(a, b)] = min(a, b)
            out.append((int(names[x]), int(names[y])))
    out += [(int(names[x]), int(names[y])) for x, y in open_pairs if root(int(component[x])) != root(int(component[y]))]
    return out


def likely(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int) -> tuple[float, float]:
    """A lower and an upper limit of the similarity of two sets from their BOTTOM smallest hashes, six and five standard
    deviations from the estimate. Sets that are no larger are known whole."""
    ends = [x[-1] for x, n in ((a, size_a), (b, size_b)) if n > BOTTOM]
    if ends:
        a, b = a[: np.searchsorted(a, min(ends), "right")], b[: np.searchsorted(b, min(ends), "right")]
    common = len(np.intersect1d(a, b, assume_unique=True))
    seen = len(a) + len(b) - common
    share = common / max(seen, 1)
    if not ends:
        return share, share
    # The hashes seen are drawn without replacement from the union.
    union = max((size_a + size_b) / (1 + share), seen)
    deviation = np.sqrt(0.1875 / seen * (1 - seen / union)) + 0.002
    return share - 6 * deviation, share + 5 * deviation


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates among all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept: one of each component. Of rows that repeat the kept doc_id, one stays, the
    first by its text. Rows without a doc_id stay, since nothing tells that they are copies."""
    found = stored(near_duplicates(docs.select("doc_id", "text")))
    gone, several = fresh(docs, "gone_id"), fresh(docs, "several_id")
    dropped = stored(found.where("doc_id is not null and not kept").select(F.col("doc_id").alias(gone)).distinct())
    # Rows without a doc_id match nothing and stay; the ids that go are the smaller side.
    left = docs.join(dropped, F.col("doc_id").cast("long") == F.col(gone), "left_anti")
    repeated = stored(found.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias(several)))
    if repeated.isEmpty():
        return left
    same = F.col("doc_id").cast("long") == F.col(several)
    first = left.join(repeated, same, "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("row"))
    return left.join(repeated, same, "left_anti").unionByName(first.select("row.*"))
