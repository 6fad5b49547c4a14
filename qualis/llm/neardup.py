"""Near-duplicate classes: BagMinHash signatures, banding, verified multiset overlap.

A document is the multiset of its five-word shingles.  Documents whose
signatures agree in a band are candidates; a candidate pair becomes a link
if the weighted Jaccard similarity of the two multisets, computed from the
texts, reaches the threshold.  Classes are the connected components.

Equal texts are one node before anything is compared.  The nodes of a
band's bucket are not paired with each other: in each round the first one
leads, the others are compared with it, links merge classes, and the leader
leaves the bucket.  A bucket whose nodes are all in one class is settled.
So copies and near copies of one text cost a comparison each, however many
there are.

Nodes of buckets that are still mixed after some leaders (texts that share a
long passage but are no near duplicates) get new, finer buckets that lose
nothing: with shingles in one common order, rare ones first, two multisets
of similarity t must share one of the first n - t*n + 1 of each.  What stands
before a shared shingle bounds the overlap, and rules most pairs out.  These
buckets take more leaders each round until all of their nodes in different
classes have been compared or ruled out: no link is lost.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualis.llm.bagminhash import mixed, signatures, weighted_jaccard
from qualis.llm.common import blocks, checkpointed, few, id_and_text, saved, slices, table
from qualis.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
#: 20 bands of 5 registers: a pair at similarity 0.8 shares a band with probability 0.9996.
BANDS, ROWS = 20, 5
#: Tables of a few longs a row are broadcast up to so many rows, else shuffled.
BROADCAST_ROWS = 1_000_000
#: Pairs of texts that a task compares, and shingles of their texts.
PAIRS_A_PARTITION, SHINGLES_A_PARTITION = 5_000, 1_000_000
#: Leaders per band in the rounds before finer buckets are made.
BAND_LEADERS = (1,)


def first_hash(text: Column) -> Column:
    return F.xxhash64(text)


def text_key(text: Column) -> Column:
    """Two 64-bit hashes of a text, which tell texts apart."""
    return F.struct(first_hash(text).alias("one"), F.xxhash64(F.lit("two"), text).alias("two"))


def with_node(rows: DataFrame) -> DataFrame:
    """Rows (text_key, ...) with node, the first hash of the text; both hashes make it where unlike texts share the first."""
    clash = rows.groupBy("text_key.one").agg(F.min("text_key.two").alias("low"), F.max("text_key.two").alias("high")).where("low < high").select("one")
    clash = checkpointed(clash)
    if clash.isEmpty():
        return rows.withColumn("node", F.col("text_key.one"))
    marked = rows.join(_small(clash.withColumn("clashes", F.lit(True))), F.col("text_key.one") == clash["one"], "left")
    node = F.when(F.col("clashes"), F.xxhash64("text_key.one", "text_key.two")).otherwise(F.col("text_key.one"))
    return marked.withColumn("node", node).drop(clash["one"]).drop("clashes")


def shingles(text: str) -> list[tuple[bytes, ...]]:
    """Runs of SHINGLE words; a shorter text is one shingle of all its words, a text without words has none."""
    words = text.encode("utf-8", "surrogatepass").split()
    if len(words) < SHINGLE:
        return [tuple(words)] if words else []
    return list(zip(*(words[i:] for i in range(SHINGLE))))


class _Words(dict):
    """word -> 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _shingle_hashes(texts: list[str], words: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count) of all texts, each shingle once a text."""
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    n = np.array([len(w) for w in split])
    flat = np.fromiter(map(words.__getitem__, (w for own in split for w in own)), np.uint64, int(n.sum()))
    start = np.cumsum(n) - n
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(texts)), count)
    at = start[doc] + np.arange(len(doc)) - (np.cumsum(count) - count)[doc]
    length = np.minimum(n, SHINGLE)[doc]
    padded = np.concatenate([flat, np.zeros(SHINGLE, np.uint64)])
    h = length.astype(np.uint64)
    for i in range(SHINGLE):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + np.where(i < length, padded[at + i], np.uint64(0)))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])) if len(doc) else np.zeros(0, np.int64)
    return doc[first], h[first], np.diff(np.concatenate([first, [len(doc)]]))


def band_keys(texts: list[str], words: _Words | None = None) -> tuple[np.ndarray, np.ndarray]:
    """int64[texts, BANDS], the hash of each band of each text's signature, and its number of shingles."""
    doc, shingle, count = _shingle_hashes(texts, _Words() if words is None else words)
    sig = signatures(doc, shingle, count, len(texts), BANDS * ROWS).reshape(len(texts), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sig.shape[:2])
    for r in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, r])
    return key.view(np.int64), np.bincount(doc, weights=count, minlength=len(texts)).astype(np.int64)


def _emit_bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to (band, node, n); n counts shingles.  Texts without words have no bands."""
    words = _Words()
    for block in blocks(batches, max_chars=2_000_000):
        texts = {n: t for n, t in zip(block["node"], block["text"]) if t.encode("utf-8", "surrogatepass").split()}
        if texts:
            keys, n = band_keys(list(texts.values()), words)
            columns = keys.ravel(), np.repeat(np.array(list(texts), np.int64), BANDS), np.repeat(n, BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["band", "node", "n"])


def similarity(a: str, b: str) -> float:
    """Weighted Jaccard similarity of two texts' shingles."""
    return weighted_jaccard(Counter(shingles(a)), Counter(shingles(b)))


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) to (a, b, similarity)."""
    last, bag = None, None
    for block in blocks(batches, "text_b", 1_000_000):
        out = []
        for a, ta, tb in zip(block["a"], block["text_a"], block["text_b"]):
            if a != last:
                last, bag = a, Counter(shingles(ta))
            out.append(weighted_jaccard(bag, Counter(shingles(tb))))
        yield pa.RecordBatch.from_arrays([pa.array(block["a"], pa.int64()), pa.array(block["b"], pa.int64()), pa.array(out, pa.float64())], names=["a", "b", "similarity"])


def _links(pairs: DataFrame, n_pairs: int, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, n), so many, that reach the threshold; n is left out.  ``texts`` (node, text) holds a row per node.

    Few pairs go to the texts, so that only texts in pairs are shuffled.
    """
    near, heads = pairs, few(pairs.select("a").distinct(), n_pairs)
    if n_pairs <= BROADCAST_ROWS:
        near, heads = F.broadcast(near), F.broadcast(heads)
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).join(heads, "a", "left_semi")
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")).join(near, "b")
    full = two.join(one, "a").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(_verify, "a long, b long, similarity double").where(F.col("similarity") >= threshold).select("a", "b")


def _small(df: DataFrame) -> DataFrame:
    """A checkpointed table of a few longs a row, marked for broadcast if it is short."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, text_key, class_key, class_id (the smallest id of the class), class_size, kept.

    Documents are linked if the weighted Jaccard similarity of their
    five-word shingles is at least ``threshold``; classes are what links
    connect.  Texts under five words are one shingle; texts without words
    (null, empty, blank) resemble none but equal texts.  The document with
    the smallest id is kept.  Null ids and repeated rows are documents like
    others; a null id is kept only where all ids of its class are null, and
    rows that share the kept id are all kept.  An empty table gives no rows.
    Texts are told apart by two 64-bit hashes (text_key).
    """
    rows = with_node(id_and_text(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text"))))
    bands = checkpointed(rows.select("node", "text").mapInArrow(_emit_bands, "band long, node long, n long"))
    shared = checkpointed(bands.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("band"))
    members = checkpointed(bands.join(_small(shared), "band", "left_semi").distinct())
    roots = checkpointed(_roots(rows, members, threshold))
    placed = rows.select("doc_id", "node", "text_key").join(_small(roots), "node", "left").select("doc_id", "text_key", F.coalesce("root", "node").alias("class_key"))
    # a table of its own, so that AQE can split the rows of a very large class in the join
    groups = checkpointed(placed.groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")))
    return placed.join(groups, "class_key").select("doc_id", "text_key", "class_key", "class_id", "class_size",
                                                   F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def _roots(rows: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(node, root) of the nodes that share a bucket: the smallest node of the class."""
    nodes = checkpointed(members.select("node").distinct())
    texts = saved(rows.select("node", "text").join(_small(nodes), "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")), "texts")
    found = _Classes(nodes, texts, threshold)
    members = members.withColumn("pos", F.lit(0).cast("long"))
    for leaders in BAND_LEADERS:
        members = found.settle(members, leaders)
        if members is None:
            return found.roots
    # both uses of the unsettled nodes' texts read the same small table
    unsettled = checkpointed(texts.join(found.mixed(members).select("node").distinct(), "node", "left_semi"))
    keys = checkpointed(ranked_shingles(unsettled).mapInArrow(_emit_prefixes(threshold), "band long, node long, n long, pos long"))
    shared = keys.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.min("n").alias("least")).where("low < high").select("band", "least")
    # the shortest member that a node can be linked to bounds how far its shared shingle may stand
    other = F.greatest(F.col("least"), F.ceil(F.lit(threshold - 1e-9) * F.col("n")))
    members = checkpointed(keys.join(shared, "band").where(F.col("n") - F.col("pos") >= F.lit(threshold / (1 + threshold) - 1e-9) * (F.col("n") + other)).drop("least"))
    found.n_members = members.count()
    leaders = 4
    while members is not None:
        members = found.settle(members, leaders)
        leaders *= 4
    return found.roots


class _Classes:
    """Links found so far, the pairs compared, and the classes they make."""

    def __init__(self, nodes: DataFrame, texts: DataFrame, threshold: float):
        self.nodes, self.texts, self.threshold = nodes, texts, threshold
        self.roots = nodes.select("node", F.col("node").alias("root"))
        self.compared = None
        self.n_nodes = nodes.count()
        self.n_members = self.n_nodes * BANDS

    def mixed(self, members: DataFrame) -> DataFrame:
        """(band, node, n, pos) of bands whose members lie in different classes, with their root."""
        placed = few(members.join(self.roots, "node"), self.n_members)
        bands = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band")
        return placed.join(bands, "band", "left_semi")

    def settle(self, members: DataFrame, leaders: int) -> DataFrame | None:
        """Compare the first nodes of each mixed band with the others; returns the members left, None if none are."""
        placed = checkpointed(self.mixed(members), self.n_members)
        self.n_members = placed.count()
        if not self.n_members:
            return None
        lead = _leaders(placed, leaders, self.n_members)
        # a leader meets the nodes of other classes that do not lead before it, unless a link is ruled out:
        # what stands before the shared place is not shared, so the overlap is at most n - pos of either
        reach = F.least(F.col("m.n") - F.col("m.pos"), F.col("l.n") - F.col("l.pos"))
        need = F.lit(self.threshold / (1 + self.threshold) - 1e-9) * (F.col("m.n") + F.col("l.n"))
        met = placed.alias("m").join(lead.alias("l"), "band").where("m.root <> l.root and m.node > l.node").where(reach >= need)
        both = met.select(F.col("l.node").alias("a"), F.col("m.node").alias("b"), (F.col("l.n") + F.col("m.n")).alias("n"))
        pairs = few(both, self.n_members * leaders).distinct()
        pairs = checkpointed(pairs if self.compared is None else pairs.join(self.compared, ["a", "b"], "left_anti"), self.n_members * leaders)
        n_pairs, n_shingles = pairs.agg(F.count(F.lit(1)), F.sum("n")).first()
        if n_pairs:
            self.compared = pairs if self.compared is None else self.compared.unionByName(pairs)
            tasks = max(n_pairs // PAIRS_A_PARTITION, n_shingles // SHINGLES_A_PARTITION) + 1
            self.merge(checkpointed(_links(pairs, n_pairs, self.texts, self.threshold).coalesce(tasks)))
        return placed.drop("root").join(lead.select("band", "node"), ["band", "node"], "left_anti")

    def merge(self, links: DataFrame) -> None:
        """Join the classes that new links (a, b) connect; older links are in the classes, so only their roots take part."""
        root = self.roots
        ends = links.join(root.select(F.col("node").alias("a"), F.col("root").alias("root_a")), "a").join(root.select(F.col("node").alias("b"), F.col("root").alias("root_b")), "b")
        between = checkpointed(ends.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct())
        moved = components(between).select(F.col("node").alias("old"), F.col("root").alias("new"))
        self.roots = checkpointed(root.join(moved, root["root"] == moved["old"], "left").select("node", F.coalesce("new", "root").alias("root")), self.n_nodes)


def _leaders(placed: DataFrame, n: int, rows: int) -> DataFrame:
    """The first n nodes of each band of a table of so many rows."""
    if n == 1:
        first = placed.groupBy("band").agg(F.min("node").alias("node"))
        return checkpointed(placed.join(first, ["band", "node"], "left_semi"), rows)
    order = Window.partitionBy("band").orderBy("node")
    return checkpointed(placed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("rank"), rows)


def ranked_shingles(texts: DataFrame) -> DataFrame:
    """(node, shingles): each text's shingles, how often it has each, and how many of the texts have it (1 is left as null).

    Counts cover all texts.  They are summed before they are shuffled and
    joined to the shingle rows, one row a shingle, so a shingle that most
    texts share only makes a partition that AQE splits; a list is as long as
    its text.
    """
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for block in blocks(batches, max_chars=1_000_000):
            doc, shingle, count = _shingle_hashes(block["text"], words)
            node = np.array(block["node"], np.int64)[doc]
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(shingle.view(np.int64)), pa.array(count, pa.int64())], names=["node", "shingle", "count"])

    rows = checkpointed(texts.mapInArrow(emit, "node long, shingle long, count long"))
    shared = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    return rows.join(shared, "shingle", "left").groupBy("node").agg(F.collect_list(F.struct("shingle", "count", "texts")).alias("shingles"))


def prefix(shingle: np.ndarray, count: np.ndarray, common: dict[str, np.ndarray], threshold: float) -> np.ndarray:
    """The first n - threshold * n + 1 elements of a multiset, frequent shingles last; the i-th copy of a shingle is an element of its own."""
    rank = np.zeros(len(shingle), np.int64)
    if len(common["shingle"]):
        at = np.minimum(np.searchsorted(common["shingle"], shingle), len(common["shingle"]) - 1)
        rank = np.where(common["shingle"][at] == shingle, common["count"][at], 0)
    copy = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    element = mixed(np.repeat(shingle, count) + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    n = len(element)
    order = np.lexsort((element, np.repeat(rank, count)))
    return element[order[:n - int(np.ceil(threshold * n - 1e-9)) + 1]]


def _emit_prefixes(threshold: float):
    """(node, shingles) to (band, node, n, pos): an element of the text's prefix, its number of elements, the element's place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            parts, totals = [], []
            for own in part.column("shingles"):
                fields = own.values
                shingle = fields.field("shingle").to_numpy().view(np.uint64)
                count, texts = fields.field("count").to_numpy(), fields.field("texts").fill_null(0).to_numpy()
                order = np.argsort(shingle)
                shingle, count = shingle[order], count[order]
                parts.append(prefix(shingle, count, {"shingle": shingle, "count": texts[order]}, threshold))
                totals.append(int(count.sum()))
            sizes = [len(p) for p in parts]
            columns = (np.concatenate(parts).view(np.int64), np.repeat(part.column("node").to_numpy(), sizes),
                       np.repeat(np.array(totals, np.int64), sizes), np.concatenate([np.arange(k) for k in sizes]))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["band", "node", "n", "pos"])

    return run


def query(spark, sf_dir: str) -> DataFrame:
    """op7: near-duplicate classes of all documents; class_key tells classes apart that share their smallest id (or have none)."""
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_key", "class_size", "kept")
