"""SimHash near-duplicates: fingerprints, BK-trees per shard, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.bktree import BKTree
from auditflow.llm.common import table, with_columns_of
from auditflow.llm.components import connected
from auditflow.session import stage

SHINGLE, DISTANCE, SEED = 4, 4, 42
# Bits are cut into this many blocks; fingerprints at distance d agree in all but d of them.
BLOCKS = 6
# Fingerprints in one tree. Larger shards are cut into trees of this size that are searched in turn.
TREE = 2_000
# Hashes whose bits are counted at once.
CHUNK = 1 << 16


def simhash_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a whole text; zero for null and texts without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words])
    line = b" ".join(words)
    width = min(shingle, len(words))
    starts = [0, *ends[: len(words) - width].tolist()]
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.fromiter(
            (hashed(line[a:b - 1], SEED) for a, b in zip(starts[at:at + CHUNK], ends[at + width - 1:].tolist())),
            dtype="<u8",
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


def simhash(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint of each text as a long; see ``simhash_of``."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([simhash_of(t, shingle) for t in batch], dtype="int64")

    return run(text)


def _blocks(blocks: int) -> list[tuple[int, int]]:
    """(shift, mask) of each block of bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class _Shard:
    """One tree, and which of its members are known to hang together.

    What is near a query is linked to it once per group of members, so links span the groups and
    never pair all of their members.
    """

    def __init__(self, radius: int) -> None:
        self.radius, self.tree, self.parent = radius, BKTree(), {}

    def _top(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def add(self, value: int) -> None:
        self.tree.add(value)
        self.parent[value] = value

    def links(self, value: int) -> list[tuple[int, int]]:
        out = []
        first = self._top(value) if value in self.parent else None
        for near in self.tree.within(value, self.radius):
            group = self._top(near)
            if first is None:
                first = group
                out.append((value, near))
            elif group != first:
                self.parent[group] = first
                out.append((value, near))
        return out


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, tree: int = TREE) -> DataFrame:
    """Links ``a, b`` that connect the distinct ``fp`` exactly as all links within ``distance`` do.

    Two fingerprints at most ``distance`` bits apart agree in at least ``blocks - distance`` blocks,
    so they share the shard of some choice of that many blocks. Every shard has its BK-tree. A shard
    of more than ``tree`` members is cut into trees of about that size, and each of its members is
    searched in each of them, so no task holds more than one tree and the members that query it.
    """
    spark = prints.sparkSession
    cut = _blocks(blocks)
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        parts = [F.shiftrightunsigned("fp", cut[i][0]).bitwiseAND(F.lit(_signed(cut[i][1]))) for i in chosen]
        keys.append(F.xxhash64(F.lit(number), *parts))
    spread = prints.select("fp", F.explode(F.array(*keys)).alias("shard"))
    sizes = spread.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    sizes = stage(sizes, "shards")
    shared = spread.join(sizes, "shard").withColumn("trees", F.ceil(F.col("n") / tree).cast("long"))
    own = F.pmod(F.xxhash64(F.lit(1), "fp"), F.col("trees"))
    # Tree t holds the members of part t; parts up to t query it.
    dealt = shared.withColumn("part", own).select(
        "shard", "fp", "part", F.explode(F.sequence(F.col("part"), F.col("trees") - 1)).alias("tree")
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = (1 << 64) - 1
        key, held, members = None, None, []
        for batch in batches:
            out = []
            for shard, number, fp, part in zip(*(batch[c].tolist() for c in ("shard", "tree", "fp", "part"))):
                if (shard, number) != key:
                    out += [link for m in members for link in held.links(m)]
                    key, held, members = (shard, number), _Shard(distance), []
                # Members come first, then what only queries them.
                if part == number:
                    held.add(fp & mask)
                    members.append(fp & mask)
                else:
                    out += held.links(fp & mask)
            yield pd.DataFrame([(_signed(a), _signed(b)) for a, b in out], columns=["a", "b"], dtype="int64")
        if members:
            out = [link for m in members for link in held.links(m)]
            yield pd.DataFrame([(_signed(a), _signed(b)) for a, b in out], columns=["a", "b"], dtype="int64")

    grouped = dealt.repartition("shard", "tree").sortWithinPartitions("shard", "tree", F.col("part").desc())
    return grouped.select("shard", "tree", "fp", "part").mapInPandas(search, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS, tree: int = TREE
) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` per row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest doc_id that links of at most ``distance`` bits reach, the row's
    own included; ``root`` is the component's smallest fingerprint. Texts that are null, empty or all
    spaces have fingerprint zero and link like any other. Rows that repeat a doc_id are each
    fingerprinted and belong to their fingerprint's component; null is a component's name only if
    none of its rows has a doc_id. Only ids and fingerprints are shuffled, equal fingerprints count
    once in the search, and an empty table gives an empty result. Other columns are not read.
    """
    prints = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), simhash(F.col("text"), shingle).alias("fp")
    )
    prints = stage(prints, "simhash")
    kinds = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-kinds")
    roots = connected(links(kinds.select("fp"), distance, blocks, tree))
    joined = stage(
        kinds.join(roots, kinds["fp"] == roots["node"], "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), "least"
        ),
        "simhash-roots",
    )
    names = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stage(joined.join(names, "root").select("fp", "root", "component_id"), "simhash-classes")
    return prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, **settings: int) -> DataFrame:
    """One document of each component: of its smallest doc_id, and of its rows the least text hash.

    A null doc_id comes last, so a component without any keeps one row, too; of rows equal in doc_id
    and text one stays. Columns are those of ``docs``.
    """
    found = near_duplicates(docs, **settings)
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "text_hash", "n")).alias("f")
    chosen = stage(rows.groupBy("root").agg(first).select("root", "f.*"), "simhash-kept").select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"), F.col("root").alias("__root"), F.col("n").alias("__n")
    )

    def of(which: DataFrame) -> DataFrame:
        same = docs["doc_id"].eqNullSafe(which["__doc"]) & (F.xxhash64(docs["text"]) == which["__text"])
        return docs.join(which, same)

    single, repeated = of(chosen.where("__n = 1")), of(chosen.where("__n > 1")).dropDuplicates(["__root"])
    return with_columns_of(single, docs).unionByName(with_columns_of(repeated, docs))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: fingerprint and component, over the whole table."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
