"""Near-duplicate classes: consistent weighted sampling over TF-IDF shingles, banded and verified.

A document's terms are its shingles of five words (all its words, if fewer),
weighted by count times inverse document frequency.  Document frequencies are
those of 2^20 hashed features over all documents, so their table has one size at
any scale; the weight of the rarest is 1 + ``IDF_SHARE`` times that of one that
all documents have, in ``IDF_STEPS`` steps.  Samples are grouped into bands;
documents that agree in a band are candidates, and those of a generalised Jaccard
similarity of at least ``SIMILAR`` are linked.  Classes are connected components.

Texts of equal shingles are one node from the start.  Any two nodes that share a
band's bucket are compared, unless they are in one class already or cannot be near
by their weights and by bits that their shingles hash to.  In a bucket of more than ``CROWD`` nodes a central node comes
first, so that most others are in its class before they would be compared, and of
the others those that share a rare shingle are compared (``link_crowds``).

Defined cases: texts without words (null, empty, marks only) are copies of equal
texts only; repeated rows are copies; null ids are rows like others, and a class
of null ids only has a null class id; equal similarities link both; an empty
table has no classes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.blocks import WORD_BYTES, Block, blocks, map_blocks, mix, small_batches, text_bytes
from tidemark.llm.sampling import Sampler, count_terms
from tidemark.sources.scratch import checkpointed

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 20, 4
FEATURES = 1 << 20
IDF_SHARE = 0.25
IDF_STEPS = 16
CROWD = 64
#: So many times as many centres in each round of a crowd.
MORE = 64
#: So many pairs of each class of a crowd are compared before all others.
LIKELIEST = 4
#: So many pairs with centres are compared at once; of more, the likeliest of each node and then of each two classes come first.
FEW_PAIRS = 1 << 12
#: Longs of the bits that say which shingles a node can have.
LONGS = 16
#: So many links are joined to classes by the driver; more by Spark, with equal results.
FEW_LINKS = 1 << 16
#: Narrow rows, and pairs to be verified, that one task reads at least, where there are so many.
TASK_ROWS = 1 << 15
TASK_PAIRS = 1 << 12
#: Of so few pairs a task's texts take little of a Python worker's memory.
PART_PAIRS = 1 << 9
#: So many narrow rows are broadcast to joins.
FEW_ROWS = 1 << 14
_CHUNK = 1 << 12
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, count) of the distinct shingles of a block."""
    words, _, _, doc = block.tokens(WORD_BYTES)
    size = np.bincount(doc, minlength=len(block))
    owners, terms = [], []
    if len(words) >= SHINGLE:
        n = len(words) - SHINGLE + 1
        term = sum((words[k : k + n] * _ODD[k] for k in range(1, SHINGLE)), words[:n] * _ODD[0])
        whole = doc[:n] == doc[SHINGLE - 1 :]
        owners.append(doc[:n][whole])
        terms.append(term[whole])
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(short):
        first = np.cumsum(size) - size
        place = np.arange(len(words)) - first[doc]
        value = words * np.array(_ODD)[np.minimum(place, SHINGLE - 1)]
        owners.append(short)
        terms.append(np.add.reduceat(value, first[size > 0])[np.searchsorted(np.flatnonzero(size > 0), short)] + size[short].astype(np.uint64))
    if not owners:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none
    return count_terms(np.concatenate(owners), mix(np.concatenate(terms)))


def feature(term: np.ndarray) -> np.ndarray:
    return (term & np.uint64(FEATURES - 1)).astype(np.int64)


def document_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """Documents per hashed feature, over all documents; tasks add up before the shuffle."""

    def rows_of(total: np.ndarray) -> pa.RecordBatch:
        parts = total.reshape(-1, _CHUNK)
        some = np.flatnonzero(parts.any(axis=1))
        return pa.RecordBatch.from_pydict(
            {"chunk": some.astype(np.int32), "n": pa.array([zlib.compress(parts[k].tobytes(), 1) for k in some], pa.binary())}
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0).to_pylist()):
                doc, term, _ = shingles(block)
                pair = np.unique(doc * FEATURES + feature(term))
                np.add.at(total, pair & (FEATURES - 1), 1)
        yield rows_of(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES // _CHUNK, _CHUNK), np.int64)
        for batch in batches:
            for chunk, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[chunk] += np.frombuffer(zlib.decompress(n), np.int64)
        yield rows_of(total.ravel())

    partial = docs.select(text_bytes(text).alias("raw")).mapInArrow(count, "chunk int, n binary")
    found = partial.repartition("chunk").mapInArrow(add, "chunk int, n binary").toArrow()
    out = np.zeros((FEATURES // _CHUNK, _CHUNK), np.int64)
    for chunk, n in zip(found.column("chunk").to_pylist(), found.column("n").to_pylist(), strict=True):
        out[chunk] += np.frombuffer(zlib.decompress(n), np.int64)
    return out.ravel()


def idf_steps(frequency: np.ndarray, docs: int) -> np.ndarray:
    """Per feature, which of ``IDF_STEPS`` weights from 1 to 1 + ``IDF_SHARE`` it has."""
    if docs < 2:
        return np.zeros(len(frequency), np.uint8)
    share = 1 - np.log(np.maximum(frequency, 1)) / np.log(docs)
    return np.clip(np.round(share * (IDF_STEPS - 1)), 0, IDF_STEPS - 1).astype(np.uint8)


STEP_WEIGHTS = tuple(1 + IDF_SHARE * k / (IDF_STEPS - 1) for k in range(IDF_STEPS))


def weights(term: np.ndarray, count: np.ndarray, steps: np.ndarray) -> np.ndarray:
    return np.array(STEP_WEIGHTS)[steps[feature(term)]] * count


def shingle_bits(doc: np.ndarray, term: np.ndarray, docs: int) -> np.ndarray:
    """docs x ``LONGS`` array of 64 bits each: those that the document's shingles hash to."""
    held = np.zeros((docs, LONGS * 64), bool)
    held[doc, (mix(term) % np.uint64(LONGS * 64)).astype(np.int64)] = True
    return np.packbits(held, axis=1).view(np.int64)


def signatures(docs: DataFrame, text: str, steps, carry: list[str]) -> DataFrame:
    """``carry`` plus node (a name of the shingles), bands (null for texts without words), total (their weight) and bits (``shingle_bits``)."""

    def make():
        sampler = Sampler(BANDS * ROWS, STEP_WEIGHTS)

        def step(block: Block) -> dict:
            doc, term, count = shingles(block)
            weight = weights(term, count, steps.value)
            sample = sampler.samples(doc, term, weight, len(block)).astype(np.uint64)
            band = np.zeros((len(block), BANDS), np.uint64)
            for k in range(ROWS):
                band = mix(band * _ODD[k] + sample.reshape(len(block), BANDS, ROWS)[:, :, k] + np.uint64(1))
            band = mix(band + np.arange(BANDS, dtype=np.uint64))
            node = np.zeros(len(block), np.uint64)
            np.add.at(node, doc, mix(term ^ mix(count.astype(np.uint64))))
            some = np.bincount(doc, minlength=len(block)) > 0
            bands = [b.tolist() if s else None for b, s in zip(band.view(np.int64), some, strict=True)]
            held = pa.ListArray.from_arrays(np.arange(len(block) + 1, dtype=np.int32) * LONGS, shingle_bits(doc, term, len(block)).ravel())
            own = {"node": pa.array(node.view(np.int64), mask=~some), "bands": pa.array(bands, pa.list_(pa.int64()))}
            return own | {"total": np.bincount(doc, weight, len(block)).astype(float), "bits": held}  # of no shingles they are integers

        return step

    return map_blocks(docs, text, make, "node bigint, bands array<bigint>, total double, bits array<bigint>", carry)


def settled(df: DataFrame, rows: int = TASK_ROWS, narrow: bool = True) -> DataFrame:
    """``df`` from a checkpoint, read by as many tasks as its rows ask for, or as wrote it, if fewer.

    Few rows in many partitions would leave many files of almost nothing in each
    later shuffle.  ``FEW_ROWS`` or fewer are broadcast to the joins that they
    meet, so that the other side of these is not shuffled for them, unless they
    are not ``narrow``.
    """
    kept = checkpointed(df, free=True)
    n = kept.coalesce(kept.sparkSession.sparkContext.defaultParallelism).count()
    kept = kept.coalesce(1 + n // rows)
    return F.broadcast(kept) if narrow and n <= FEW_ROWS else kept


def met_buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, band, n): the rows of buckets of two or more nodes, with n, their number."""
    rows = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return settled(rows.join(sizes, "bucket"))


def crowd_terms(nodes: DataFrame, packed: DataFrame, steps) -> DataFrame:
    """(node, total, term, weight) of all shingles of the given nodes; total is the node's weight."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            node = batch.column(0).to_numpy()
            for block in blocks([tool.decompress(p) for p in batch.column(1).to_pylist()]):
                doc, term, count = shingles(block)
                weight = weights(term, count, steps.value)
                total = np.bincount(doc, weight, len(block))
                yield pa.RecordBatch.from_pydict({"node": node[block.first + doc], "total": total[doc], "term": term.view(np.int64), "weight": weight})

    return packed.join(nodes.select("node").distinct(), "node", "left_semi").select("node", "packed").mapInArrow(spell, "node bigint, total double, term bigint, weight double")


def rare_shares(terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, total, rare): weights of all shingles, and of those that at most ``CROWD`` nodes have; and the latter's rows.

    The rows (node, term, first) say whether a shingle is among the node's rarest
    that together exceed 1 - ``SIMILAR`` of its weight.
    """
    terms = settled(terms)
    few = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("weight").alias("weight"))
    few = settled(few.filter(F.col("n") <= CROWD))
    # shingles of one node need not meet it again
    alone = few.filter("n = 1").groupBy("node").agg(F.sum("weight").alias("alone"))
    nodes = terms.groupBy("node").agg(F.max("total").alias("total")).join(alone, "node", "left")
    nodes = settled(nodes.select("node", "total", F.coalesce("alone", F.lit(0.0)).alias("alone")))
    rows = terms.drop("total").join(few.filter("n > 1").select("term", "n"), "term").join(nodes, "node")
    order = Window.partitionBy("node").orderBy("n", "term").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("alone") + F.coalesce(F.sum("weight").over(order), F.lit(0.0))
    rows = settled(rows.select("node", "term", "weight", (before <= (1 - SIMILAR) * F.col("total") + 1e-9).alias("first")))
    shared = rows.groupBy("node").agg(F.sum("weight").alias("shared"))
    shares = nodes.join(shared, "node", "left").select("node", "total", (F.col("alone") + F.coalesce("shared", F.lit(0.0))).alias("rare"))
    return settled(shares), rows.select("node", "term", "first")


def rare_pairs(rows: DataFrame, label: DataFrame, best: int | None = None) -> DataFrame:
    """Distinct pairs a < b of different classes that share a shingle that is among the rarest of one of them.

    ``rows`` has (node, terms), terms being all of a node's (term, first) of ``rare_shares``.  With ``best``, only so many of each class: those that share the most such shingles.
    """
    one = F.struct("node", "class", "first")
    rows = rows.join(label, "node").select("node", "class", F.inline("terms"))
    few = rows.groupBy("term").agg(F.collect_list(one).alias("all"), F.min("class").alias("low"), F.max("class").alias("high"))
    few = few.filter("low < high").select(F.explode("all").alias("x"), "all")
    others = F.filter("all", lambda y: (y["node"] > F.col("x.node")) & (y["class"] != F.col("x.class")) & (y["first"] | F.col("x.first")))
    pairs = few.select("x", F.explode(others).alias("y")).groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    if best is not None:
        pairs = pairs.agg(F.count(F.lit(1)).alias("shared"), F.array(F.first("x.class"), F.first("y.class")).alias("both"))
        order = Window.partitionBy("class").orderBy(F.desc("shared"), "a", "b")
        ranked = pairs.select("a", "b", "shared", F.explode("both").alias("class")).withColumn("place", F.row_number().over(order))
        pairs = ranked.filter(F.col("place") <= best).groupBy("a", "b")
    return settled(pairs.agg(F.count(F.lit(1))).select("a", "b"), TASK_PAIRS)


def may_miss(x, y):
    """The weight of a text of weight ``x`` that a near text of weight ``y`` can lack."""
    return x - SIMILAR / (1 + SIMILAR) * (x + y)


def may_be_near(x, x_bits, y, y_bits):
    """Whether texts of weights ``x`` and ``y`` can be near: false only if they are not.

    For each bit that one has alone it has a shingle that the other lacks, of a weight of 1 or more.
    """

    def alone(p, q):
        return sum((F.bit_count(p[i].bitwiseAND(F.bitwise_not(q[i]))) for i in range(1, LONGS)), F.bit_count(p[0].bitwiseAND(F.bitwise_not(q[0]))))

    return (alone(x_bits, y_bits) <= may_miss(x, y) + 1e-6) & (alone(y_bits, x_bits) <= may_miss(y, x) + 1e-6)


def centre_pairs(rows: DataFrame, centres: DataFrame, later: bool) -> DataFrame:
    """(node, centre, low, high, agree): the centres of other classes in a node's buckets that can be near; both classes; in how many bands they agree.

    ``later`` leaves out those that share a rare shingle, if they are near.
    """
    own = [F.col(c).alias(n) for c, n in (("node", "centre"), ("class", "c"), ("bands", "b"), ("total", "centre_total"), ("rare", "centre_rare"), ("bits", "centre_bits"))]
    ours = settled(rows.join(centres, "node", "left_semi").select("bucket", *own))
    same = F.zip_with("bands", "b", lambda x, y: x == y)
    on = [F.col("l.bucket") == F.col("r.bucket"), F.col("class") != F.col("c")]
    on.append(may_be_near(F.col("total"), F.col("bits"), F.col("centre_total"), F.col("centre_bits")))
    if later:
        on.append(F.col("rare") <= may_miss(F.col("total"), F.col("centre_total")) + 1e-9)
        on.append(F.col("centre_rare") <= may_miss(F.col("centre_total"), F.col("total")) + 1e-9)
    # two nodes meet only in the first of the buckets that they share
    on.append(F.array_position(same, True) == F.col("band") + 1)
    pairs = rows.filter("not tried").alias("l").join(ours.alias("r"), on)
    return pairs.select("node", "centre", F.least("class", "c").alias("low"), F.greatest("class", "c").alias("high"), F.size(F.filter(same, lambda s: s)).alias("agree"))


def link_crowds(met: DataFrame, nodes: DataFrame, label: DataFrame, packed: DataFrame, steps) -> DataFrame:
    """``label`` after all links within the buckets of more than ``CROWD`` nodes.

    First the most supported node of each bucket, its centre, is compared with all
    of it that can be near by weights and bits and is not in its class by likelier pairs.  Then those that share a rare shingle are compared, the likeliest of each
    class first, and all that are in different classes after these: a near text of weight
    y lacks at most ``may_miss(x, y)`` of a text of weight x, so if the rare shingles of
    either weigh more than that, near texts share one.  Rounds of centres are left for
    pairs of which neither's do: of each bucket the most supported nodes outside its
    largest class that have not been centres, ``MORE`` times as many in each round.  A
    bucket is done when all nodes outside its largest class have been centres, or
    have rare shingles enough for any partner.
    """
    crowd = met.filter(F.col("n") > CROWD)
    if crowd.isEmpty():
        return label
    shares, rare = rare_shares(crowd_terms(crowd, packed, steps))
    rare = settled(rare.groupBy("node").agg(F.collect_list(F.struct("term", "first")).alias("terms")), narrow=False)
    support = crowd.groupBy("node").agg(F.sum("n").alias("support"))
    crowd = settled(crowd.drop("n").join(support.join(nodes.select("node", "bands", "bits"), "node").join(shares, "node"), "node"))
    tried = None
    most = 1
    while True:
        now = label if tried is None else label.join(tried.withColumn("tried", F.lit(True)), "node", "left")
        now = now.select("node", "class", (F.lit(False) if tried is None else F.col("tried").isNotNull()).alias("tried"))
        rows = settled(crowd.join(now, "node"))
        sizes = rows.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "class"))["class"].alias("largest"))
        order = Window.partitionBy("bucket").orderBy(F.desc("support"), "node")
        rest = rows.filter("not tried").select("bucket", "node", "support", "class", "total", "rare").join(largest, "bucket").filter("class != largest")
        if tried is not None:
            rest = rest.filter(F.col("rare") <= (1 - SIMILAR) * F.col("total") + 1e-9)
        centres = rest.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).select("node").distinct()
        centres = settled(centres)
        if tried is not None and centres.isEmpty():
            return label
        # nodes and classes that their likeliest pairs join need none of the others between them
        for of in (["node"], ["low", "high"], None):
            pairs = settled(centre_pairs(rows, centres, tried is not None))
            few = of is None or pairs.count() <= FEW_PAIRS
            if not few:
                pairs = pairs.groupBy(of).agg(F.max(F.struct("agree", "centre", "node")).alias("x")).select("x.node", "x.centre")
            pairs = pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
            label = merged(label, settled(verify(settled(pairs, TASK_PAIRS), packed, steps)))
            if few:
                break
            rows = settled(rows.drop("class").join(label, "node"))
        if tried is None:
            # a class that its likeliest pairs join needs none of its others
            for best in (LIKELIEST, None):
                label = merged(label, settled(verify(rare_pairs(rare, label, best), packed, steps)))
        tried = centres if tried is None else settled(tried.unionByName(centres))
        most *= MORE


def small_pairs(met: DataFrame, nodes: DataFrame, label: DataFrame) -> DataFrame:
    """Distinct pairs a < b, of different classes, that share a bucket of up to ``CROWD`` nodes and can be near."""
    rows = met.filter(F.col("n") <= CROWD).join(label, "node").join(nodes.select("node", "total", "bits"), "node")
    one = F.struct("node", "class", "total", "bits")
    few = rows.groupBy("bucket").agg(F.array_sort(F.collect_list(one)).alias("all"), F.min("class").alias("low"), F.max("class").alias("high"))
    few = few.filter("low < high").select(F.explode("all").alias("x"), "all")
    near = lambda y: may_be_near(F.col("x.total"), F.col("x.bits"), y["total"], y["bits"])
    others = F.filter("all", lambda y: (y["node"] > F.col("x.node")) & (y["class"] != F.col("x.class")) & near(y))
    return settled(few.select(F.col("x.node").alias("a"), F.explode(F.transform(others, lambda y: y["node"])).alias("b")).distinct(), TASK_PAIRS)


def packed_texts(used: DataFrame, nodes: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(node, packed): the compressed texts of the nodes of ``used``."""
    used = used.join(nodes.select("node", "text_key"), "node")
    raw = text_bytes(text)
    texts = docs.select(F.xxhash64(raw).alias("text_key"), raw.alias("raw")).join(used.select("text_key", "node"), "text_key")

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [tool.compress(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"node": batch.column(0), "packed": pa.array(packed, pa.binary())})

    packed = texts.select("node", "raw").mapInArrow(press, "node bigint, packed binary")
    return checkpointed(packed.groupBy("node").agg(F.first("packed").alias("packed")), free=True)


def verify(pairs: DataFrame, packed: DataFrame, steps) -> DataFrame:
    """(a, b) of generalised Jaccard similarity ``SIMILAR`` or more, from the whole texts.

    Texts of no more pairs than one task reads are picked where they lie, and no others are shuffled.
    """
    n = pairs.count()
    if n <= TASK_PAIRS:
        ends = F.broadcast(pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node")))
        held = packed.join(ends, "node").repartition(1 + n // PART_PAIRS, "a", "b")
        text_of = lambda c: F.first(F.when(F.col("node") == F.col(c), F.col("packed")), ignorenulls=True).alias(f"packed_{c}")
        both = held.groupBy("a", "b").agg(text_of("a"), text_of("b"))
    else:
        both = pairs.join(packed.toDF("b", "packed_b"), "b").join(packed.toDF("a", "packed_a"), "a")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        size = 0

        def terms_of(node: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
            nonlocal size
            if node not in held:
                if size > 4_000_000:
                    held.clear()
                    size = 0
                _, term, count = shingles(Block(0, [tool.decompress(data)]))
                held[node] = (term, weights(term, count, steps.value))
                size += len(term)
            return held[node]

        for batch in batches:
            a, b, pa_, pb = (batch.column(batch.schema.names.index(c)).to_pylist() for c in ("a", "b", "packed_a", "packed_b"))
            same = []
            for i, j, x, y in zip(a, b, pa_, pb, strict=True):
                (s, v), (t, w) = terms_of(i, x), terms_of(j, y)
                at = np.minimum(np.searchsorted(s, t), len(s) - 1)
                met = s[at] == t
                shared = np.minimum(v[at[met]], w[met]).sum()
                same.append(bool(shared >= SIMILAR * (v.sum() + w.sum() - shared) - 1e-9))
            yield pa.RecordBatch.from_pydict({"a": batch.column(batch.schema.names.index("a")), "b": batch.column(batch.schema.names.index("b"))}).filter(pa.array(same, pa.bool_()))

    return both.mapInArrow(judge, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, class): the least node of each connected component; labels spread along links and jump to their labels'."""
    both = settled(links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("l")).select("l.*"))
    label = settled(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("c")))
    while True:
        near = both.join(label.toDF("v", "cv"), "v").groupBy("u").agg(F.min("cv").alias("m"))
        low = label.join(near, "u").select("u", F.least("c", "m").alias("c"), F.col("c").alias("was"))
        jump = low.join(label.toDF("c", "cc"), "c", "left").select("u", F.least("c", F.coalesce("cc", "c")).alias("c"), "was")
        jump = settled(jump)
        changed = not jump.filter("c != was").isEmpty()
        label = jump.drop("was")
        if not changed:
            return label.toDF("node", "class")


def joined_here(links: DataFrame) -> DataFrame:
    """What ``components`` finds, as (class, new), of few links by the driver itself."""
    table = links.toArrow()
    least: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := least.setdefault(x, x)) != x:
            least[x] = x = least[up]
        return x

    for a, b in zip(table.column("a").to_pylist(), table.column("b").to_pylist(), strict=True):
        a, b = top(a), top(b)
        least[max(a, b)] = min(a, b)
    found = {"class": pa.array(list(least), pa.int64()), "new": pa.array([top(x) for x in list(least)], pa.int64())}
    return links.sparkSession.createDataFrame(pa.table(found))


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (node, class) with the classes joined that ``links`` connect; a class is named by its least node."""
    if links.isEmpty():
        return label
    ends = links.select("a", "b", F.explode(F.array("a", "b")).alias("node")).join(label, "node")
    between = ends.groupBy("a", "b").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    between = settled(between.select(F.col("low").alias("a"), F.col("high").alias("b")).distinct())
    if between.count() <= FEW_LINKS:
        new = F.broadcast(joined_here(between))
    else:
        new = components(between).toDF("class", "new")
    return settled(label.join(new, "class", "left").select("node", F.coalesce("new", "class").alias("class")))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, class, class_id): class_id is the least id of the class."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("raw", text_bytes("text"))
    frequency = document_frequencies(rows, "text")
    steps = docs.sparkSession.sparkContext.broadcast(idf_steps(frequency, rows.count()))
    keyed = rows.withColumn("text_key", F.xxhash64("raw"))
    signed = signatures(keyed, "raw", steps, ["doc_id", "text_key"])
    signed = checkpointed(signed.withColumn("node", F.coalesce("node", F.xxhash64("text_key", F.lit("no words")))))
    nodes = signed.filter(F.col("bands").isNotNull()).groupBy("node").agg(*[F.first(c).alias(c) for c in ("bands", "total", "bits")], F.min("text_key").alias("text_key"))
    nodes = checkpointed(nodes, free=True)
    met = met_buckets(nodes)
    used = settled(met.select("node").distinct())
    packed = packed_texts(used, nodes, rows, "text")
    label = link_crowds(met, nodes, used.select("node", F.col("node").alias("class")), packed, steps)
    found = merged(label, settled(verify(small_pairs(met, nodes, label), packed, steps)))
    member = signed.select("doc_id", "text_key", "node").join(found, "node", "left")
    member = checkpointed(member.withColumn("class", F.coalesce("class", "node")), free=True)
    # a table of its own, so that the join can split a common class
    least = settled(member.groupBy("class").agg(F.min("doc_id").alias("class_id")))
    out = member.join(least, "class")
    return out.select("doc_id", "text_key", "class", "class_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs``; of each class only the row of the least id (nulls last), or one of its repeated rows.

    A row is known by its id and text, so those of the rows that stay join back;
    of rows that are equal in both, one stays.
    """
    own = docs.columns
    held = [f"c{i}" for i in range(len(own))]
    i, t = held[own.index(doc_id)], held[own.index(text)]
    renamed = docs.toDF(*held)
    found = classes(renamed, i, t)
    stay = found.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("least"))
    stay = stay.select(F.xxhash64("least.no_id", "least.doc_id", "least.text_key").alias("row"))
    keyed = renamed.withColumn("row", F.xxhash64(F.col(i).isNull(), i, F.xxhash64(text_bytes(t))))
    return keyed.join(stay, "row", "left_semi").dropDuplicates(["row"]).select(*held).toDF(*own)


def query(spark, folder: str) -> DataFrame:
    small_batches(spark)
    return classes(spark.read.parquet(f"{folder}/documents.parquet")).drop("text_key", "class")
