"""N-gram Jaccard self-join by MinHash banding, verified on full n-gram sets.

``link_documents`` gives each document its group and its number of links: the
other documents whose set of five-word shingles has a Jaccard similarity of at
least ``threshold`` with its own.  Documents with equal sets are one class and
are compared once.  Texts of fewer than five words have one shingle of all
their words; texts without a word (null: empty) form one class of their own.
Classes are told apart by their shingle sets and numbered, never by an id, so
ids may be null or stand on several texts.  Repeated rows count one by one.

Candidates come from bands of the signature, with rows and bands chosen for
the target recall.  Small buckets give their pairs.  Buckets of more than
``SMALL`` classes, as a large group of near copies makes, are merged into
clusters, whose members are compared in blocks inside tasks, all with all; a
task returns link counts and a spanning forest, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import textops as T
from .common import sendable, texts, written
from .graph import components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Classes of a bucket that are still paired as rows; larger ones go to blocks.
SMALL = 8
#: Classes of a cluster that a task compares with as many others.
BLOCK = 256


def bands_for(threshold: float, recall: float, most: int = 128) -> tuple[int, int]:
    """The most rows a band can have, and the fewest bands of them, so that a pair
    at the threshold shares a band with probability ``recall``, within ``most`` minima."""
    for rows in range(most, 0, -1):
        p = threshold ** rows
        bands = int(np.ceil(np.log(1 - recall) / np.log1p(-p))) if p < 1 else 1
        if rows * bands <= most:
            return bands, rows
    return most, 1


KEY = ["k1", "k2", "n_shingles"]
KEY_TYPE = StructType([StructField(k, LongType()) for k in KEY])


def set_keys(sh: np.ndarray, sd: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits (two rows) and the number of distinct shingles of each document's set; equal sets have equal keys."""
    order = np.lexsort((sh, sd))
    s, d = sh[order], sd[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    s, d = s[new], d[new]
    at = np.searchsorted(d, np.arange(n + 1))
    key = np.zeros((2, n), np.uint64)
    full = np.flatnonzero(at[1:] > at[:-1])
    if len(full):
        # two sums over the distinct shingles
        for i, v in enumerate((T.mix(s), T.mix(s ^ np.uint64(0x5851F42D4C957F2D)))):
            key[i][full] = np.add.reduceat(v, at[:-1][full])
    return key, np.diff(at)


def band_hashes(sig: np.ndarray, size: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash of each band of ``rows`` minima; 0 for documents without a shingle."""
    hashes = np.zeros((len(sig), bands), np.uint64)
    for i in range(bands):
        x = np.full(len(sig), i, np.uint64)
        for r in range(rows):
            x = T.mix(x + sig[:, i * rows + r].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        hashes[:, i] = x
    hashes[size == 0] = 0
    return hashes


@F.pandas_udf(KEY_TYPE)
def set_key(text: pd.Series) -> pd.DataFrame:
    """The class key of each text."""
    keys, sizes = [np.zeros((2, 0), np.uint64)], [np.zeros(0, np.int64)]
    for b in T.blocks([pa.RecordBatch.from_arrays([pa.array(text, pa.string())], names=["text"])]):
        h, doc, _, _ = T.words(*T.utf8(T.column(b, "text")))
        key, size = set_keys(*T.shingles(h, doc, SHINGLE, b.num_rows), b.num_rows)
        keys.append(key)
        sizes.append(size)
    k = np.concatenate(keys, axis=1).view(np.int64)
    return pd.DataFrame({"k1": k[0], "k2": k[1], "n_shingles": np.concatenate(sizes)})


def _sketch(docs: DataFrame, bands: int, rows: int, seed: int, permutations: int) -> DataFrame:
    """``doc_id``, the class key (128 bits of the shingle set) and the band hashes."""

    def run(batches):
        mh = T.MinHash(permutations, seed)
        for b in T.blocks(batches):
            data, off = T.utf8(T.column(b, "text"))
            h, doc, _, _ = T.words(data, off)
            sh, sd = T.shingles(h, doc, SHINGLE, b.num_rows)
            key, size = set_keys(sh, sd, b.num_rows)
            hashes = band_hashes(mh.signatures(sh, sd, b.num_rows), size, bands, rows)
            yield pa.RecordBatch.from_arrays(
                [T.column(b, "doc_id"), pa.array(key[0].view(np.int64)), pa.array(key[1].view(np.int64)), pa.array(size),
                 pa.FixedSizeListArray.from_arrays(pa.array(hashes.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64()))],
                names=["doc_id", "k1", "k2", "n_shingles", "bands"])

    return texts(docs).mapInArrow(run, "doc_id long, k1 long, k2 long, n_shingles long, bands array<long>")


def _numbered_sets(docs: DataFrame) -> DataFrame:
    """The class number ``rep`` that comes with each text, and its sorted distinct shingles as bytes."""

    def run(batches):
        for b in T.blocks(batches):
            h, doc, _, _ = T.words(*T.utf8(T.column(b, "text")))
            sh, sd = T.shingles(h, doc, SHINGLE, b.num_rows)
            yield pa.RecordBatch.from_arrays([T.column(b, "rep"), pa.array([s.tobytes() for s in T.sets(sh, sd, b.num_rows)], pa.binary())], names=["rep", "shingles"])

    return docs.mapInArrow(run, "rep long, shingles binary")


def _shingle_sets(docs: DataFrame) -> DataFrame:
    """The class key of each document and its sorted distinct shingles as bytes."""

    def run(batches):
        for b in T.blocks(batches):
            h, doc, _, _ = T.words(*T.utf8(T.column(b, "text")))
            sh, sd = T.shingles(h, doc, SHINGLE, b.num_rows)
            key, size = set_keys(sh, sd, b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(key[0].view(np.int64)), pa.array(key[1].view(np.int64)), pa.array(size), pa.array([s.tobytes() for s in T.sets(sh, sd, b.num_rows)], pa.binary())], names=[*KEY, "shingles"])

    return docs.mapInArrow(run, "k1 long, k2 long, n_shingles long, shingles binary")


def _verify_pairs(pairs: DataFrame, threshold: float) -> DataFrame:
    """Of ``a, b, sa, sb`` the pairs whose sets are similar enough."""

    def run(batches):
        for batch in batches:
            sa, sb = T.column(batch, "sa"), T.column(batch, "sb")
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (sa, sb))
                if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                    continue
                both = np.intersect1d(x, y, assume_unique=True).size
                ok[i] = both >= threshold * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([T.column(batch, "a"), T.column(batch, "b")], names=["a", "b"]).filter(pa.array(ok))

    return pairs.mapInArrow(run, "a long, b long")


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``x`` shares with each of ``y``, by sums of outer products."""
    vx, vy = np.concatenate(x), np.concatenate(y)
    both = np.intersect1d(vx, vy)
    out = np.zeros((len(x), len(y)), np.float32)
    if not len(both):
        return out.astype(np.int64)

    def place(parts: list[np.ndarray], v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        who = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        at = np.searchsorted(both, v)
        at[at == len(both)] = 0
        hit = both[at] == v
        at, who = at[hit], who[hit]
        order = np.argsort(at, kind="stable")
        return at[order], who[order]

    ax, wx = place(x, vx)
    ay, wy = place(y, vy)
    step = 4096
    for lo in range(0, len(both), step):
        a, b = (np.searchsorted(v, [lo, lo + step]) for v in (ax, ay))
        m, n = np.zeros((len(x), step), np.float32), np.zeros((len(y), step), np.float32)
        m[wx[a[0]:a[1]], ax[a[0]:a[1]] - lo] = 1
        n[wy[b[0]:b[1]], ay[b[0]:b[1]] - lo] = 1
        out += m @ n.T
    return np.rint(out).astype(np.int64)


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component under links ``i, j``."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _compare_blocks(members: DataFrame, threshold: float) -> DataFrame:
    """Compare the blocks ``left`` and ``right`` of a cluster: each member's links
    (documents), and the smallest member that it is connected to there."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", kind="stable").reset_index(drop=True)
        i, j = pdf["left"].iloc[0], pdf["right"].iloc[0]
        sets = [np.frombuffer(s, np.uint64) for s in pdf["shingles"]]
        size, rep, block = pdf["size"].to_numpy(), pdf["rep"].to_numpy(), pdf["block"].to_numpy()
        mine, theirs = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links = np.zeros(len(rep), np.int64)
        if not len(mine) or not len(theirs):
            return pd.DataFrame({"rep": rep, "links": links, "root": rep})
        both = common_counts([sets[k] for k in mine], [sets[k] for k in theirs])
        n = np.array([len(s) for s in sets])
        ok = both >= threshold * (n[mine][:, None] + n[theirs][None, :] - both)
        if i == j:
            ok &= ~np.eye(len(mine), dtype=bool)
            links[mine] = ok @ size[mine]
        else:
            links[mine] = ok @ size[theirs]
            links[theirs] = ok.T @ size[mine]
        a, b = np.nonzero(ok)
        return pd.DataFrame({"rep": rep, "links": links, "root": rep[_forest(len(rep), mine[a], theirs[b])]})

    return members.groupBy("cluster", "left", "right").applyInPandas(run, "rep long, links long, root long")


def groups(docs: DataFrame, bands: int, rows: int, seed: int, permutations: int, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Two written tables: the documents (``doc_id`` and class key), and one row per
    class with its key, ``root`` (a number of the group that links connect),
    ``class_id`` (the group's smallest id), ``n_links``, ``copy_of`` and ``n_copies``.

    Bands of ``rows`` minima are taken from a signature of ``permutations`` minima.
    """
    member = written(_sketch(docs, bands, rows, seed, permutations), "jaccard-sketch")
    # a number (rep) for each class; equal sets have equal bands, so any row's will do
    classes = member.groupBy(*KEY).agg(F.min("doc_id").alias("low_id"), F.count("*").alias("size"), F.first("bands").alias("bands"))
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "jaccard-classes")
    alive = classes.where("n_shingles > 0")

    band = alive.select("rep", F.posexplode("bands").alias("band", "h"))
    full = band.groupBy("band", "h").agg(F.count("*").alias("m"), F.min("rep").alias("low")).where("m > 1")
    full = written(full, "jaccard-buckets")
    met = written(band.join(full, ["band", "h"]), "jaccard-met")

    # large buckets, merged where they share a member: the cluster is named by its smallest member
    hot = components(met.where(F.col("m") > SMALL).select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct(), "jaccard-hot")
    hot = written(hot.select(F.col("node").alias("c_rep"), F.col("root").alias("cluster")), "jaccard-clusters")

    # pairs of small buckets (at most SMALL rows each), unless one cluster holds both
    small = met.where(F.col("m") <= SMALL).groupBy("band", "h").agg(F.sort_array(F.collect_list("rep")).alias("reps"))
    pair = small.select(F.posexplode("reps").alias("at", "a"), "reps").select("a", F.explode(F.slice("reps", F.col("at") + 2, F.lit(SMALL))).alias("b")).distinct()
    ca, cb = hot.select(F.col("c_rep").alias("a"), F.col("cluster").alias("ca")), hot.select(F.col("c_rep").alias("b"), F.col("cluster").alias("cb"))
    pair = pair.join(ca, "a", "left").join(cb, "b", "left").where("ca is null or cb is null or ca <> cb").select("a", "b")
    pair = written(pair, "jaccard-pairs")

    # the sets of those documents alone
    wanted = written(pair.select(F.col("a").alias("w")).union(pair.select("b")).union(hot.select("c_rep")).distinct(), "jaccard-wanted")
    low = F.coalesce("low_id", F.lit(-(1 << 63)))  # for null; what it picks in excess has another key
    wanted = written(classes.join(wanted, F.col("rep") == F.col("w")).select(*KEY, "rep", low.alias("w_id")), "jaccard-wanted-keys")
    # An id that stands on one row alone carries its class number to the text, so a set is made
    # once and stays where it is.  Few enough of these ids go to every task, and the texts
    # stay where they are; else the texts are dealt out by id.
    alone = member.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("m")).where("m = 1").select(F.col("doc_id").alias("w_id"))
    one = written(wanted.join(alone, "w_id").select("w_id", "rep"), "jaccard-wanted-one")
    sets = _numbered_sets(texts(docs).join(sendable(one), F.col("doc_id") == F.col("w_id")).select("rep", "text"))
    # a null or repeated id may stand on other texts too: the key tells them apart
    many = written(wanted.join(one.select("rep"), "rep", "left_anti"), "jaccard-wanted-many")
    if not many.isEmpty():
        ids = written(many.select("w_id").distinct(), "jaccard-wanted-ids")
        picked = texts(docs).join(sendable(ids), F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("w_id"), "left_semi")
        sets = sets.unionByName(_shingle_sets(picked).dropDuplicates(KEY).join(many, KEY).select("rep", "shingles"))
    sets = written(sets, "jaccard-sets")

    with_a = pair.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
    with_b = with_a.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
    linked = written(_verify_pairs(with_b, threshold), "jaccard-linked")

    size = classes.select(F.col("rep").alias("s_rep"), "size")
    held = sets.join(hot, F.col("rep") == F.col("c_rep")).join(size, F.col("rep") == F.col("s_rep")).select("cluster", "rep", "size", "shingles")
    count = hot.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    held = held.join(count, "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    turns = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("block"), o).cast("int").alias("left"), F.greatest(F.col("block"), o).cast("int").alias("right")))
    held = held.select("cluster", "rep", "size", "shingles", "block", F.inline(turns))
    compared = written(_compare_blocks(held, threshold), "jaccard-compared")

    two = linked.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(linked.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    by_pair = two.join(size, F.col("other") == F.col("s_rep")).select("rep", F.col("size").alias("links"))
    links = by_pair.unionByName(compared.select("rep", "links")).groupBy("rep").agg(F.sum("links").alias("links"))

    group = components(linked.select("a", "b").unionByName(compared.where("root <> rep").select(F.col("rep").alias("a"), F.col("root").alias("b"))), "jaccard-groups")
    lows = group.join(classes.select(F.col("rep").alias("node"), "low_id"), "node").groupBy("root").agg(F.min("low_id").alias("group_id"))
    group = group.join(written(lows, "jaccard-lows"), "root")
    c = classes.select(*KEY, "rep", "low_id", "size").join(links.withColumnRenamed("rep", "l_rep"), F.col("rep") == F.col("l_rep"), "left")
    c = c.join(group, F.col("rep") == F.col("node"), "left")
    # a table again, so that a class of very many copies can be split in the join
    c = written(c.select(*KEY, F.coalesce("root", "rep").alias("root"), F.col("low_id").alias("copy_of"), F.col("size").alias("n_copies"), F.coalesce("group_id", "low_id").alias("class_id"),
                         (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")), "jaccard-results")
    return member.select("doc_id", *KEY), c


def link_documents(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 3) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (the smallest id of the group
    that links connect), ``n_links`` (documents linked to it, copies included),
    ``copy_of`` (the smallest id with the same shingle set) and ``n_copies`` (documents of that set)."""
    bands, rows = bands_for(threshold, recall)
    member, c = groups(docs, bands, rows, seed, bands * rows, threshold)
    return member.join(c, KEY).select("doc_id", "class_id", "n_links", "copy_of", "n_copies")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows, all columns, without those that a link or an equal shingle set joins to
    a smaller id.  Of a group's rows with one repeated id the one of smallest text stays;
    an id's rows in other groups are decided there.  Rows with a null id stay."""
    bands, rows = bands_for(threshold, recall)
    member, c = groups(docs, bands, rows, 3, bands * rows, threshold)
    linked = written(member.where("doc_id is not null").join(c, KEY).select(F.col("doc_id").alias("j_id"), "class_id", "root", *KEY), "jaccard-kept")
    by_id = written(linked.groupBy("j_id").agg(F.count("*").alias("n"), F.max(F.col("j_id") != F.col("class_id")).alias("out")).where("n > 1 or out"), "jaccard-ids")
    gone = by_id.where("n = 1").select("j_id")
    left = docs.join(sendable(gone), docs["doc_id"] == gone["j_id"], "left_anti")
    # repeated ids are few: only their rows are compared by key and text
    again = by_id.where("n > 1").select("j_id")
    if again.isEmpty():
        return left
    some = left.join(again, left["doc_id"] == again["j_id"], "left_semi")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    one = F.min_by(F.struct(*docs.columns), text)
    some = some.groupBy(F.col("doc_id").cast("long").alias("j_id"), set_key(text).alias("key")).agg(one.alias("row"))
    some = some.select("j_id", "key.*", "row")
    first = linked.where("j_id = class_id").join(again, "j_id", "left_semi").select("j_id", "root", *KEY).distinct()
    some = some.join(first, ["j_id", *KEY]).groupBy("root").agg(F.min_by("row", F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("row"))
    return left.join(again, left["doc_id"] == again["j_id"], "left_anti").unionByName(some.select("row.*"))
