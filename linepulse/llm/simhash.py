"""SimHash near-duplicates: exact linking of fingerprints by tiles of equal population counts.

Distinct fingerprints are dealt into cells by the population counts of their four quarters. Two
fingerprints at distance r differ by at most r in the sum of those counts, so only tiles of cells
that near are compared, by exclusive-or and bit counts over whole tiles in numpy; all other tile
pairs are skipped. Each compared pair of tiles gives a spanning forest of its links, and rounds of
large-star and small-star grouping turn the links into components.

Null text is an empty document; documents without a word have fingerprint zero and are linked with
each other. Texts of any length are hashed whole. A bit that exactly half of the hashes set is 0. Repeated rows
give repeated results. An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import map_batches, materialize, ship, text_or_empty

#: Fingerprints of a tile, about.
TILE = 8192
#: Comparisons done at once.
AT_ONCE = 1 << 21


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """64 bits: each is 1 if it is set in over half the hashes of the word shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        found = [b" ".join(words)]
    else:
        found = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in found), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.add.reduce(np.unpackbits(part, axis=1, bitorder="little"), axis=0, dtype=np.uint32)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and fingerprint (the bits as a signed long) of every whole text."""

    def work(batches):
        for batch in batches:
            found = [fingerprint(t, shingle, seed) for t in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "fingerprint": np.array(found, np.uint64).view(np.int64),
            }

    return map_batches(
        docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text")),
        "doc_id bigint, fingerprint bigint",
        work,
    )


def _quarter(k: int):
    return F.bit_count(F.shiftrightunsigned("fingerprint", 16 * k).bitwiseAND(F.lit(0xFFFF)))


def _cell_steps(radius: int) -> list[int]:
    """Differences of cell numbers to the cells near enough, one of each two opposite ones."""
    out = []
    for step in product(range(-radius, radius + 1), repeat=4):
        if sum(map(abs, step)) <= radius and step >= (0, 0, 0, 0):
            out.append(sum(s << (6 * k) for k, s in enumerate(step[::-1])))
    return out


def forest(a: np.ndarray, b: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between a and b at distance 1 to `radius`, without those that close a circle."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    rows = max(1, AT_ONCE // max(1, len(b)))
    for at in range(0, len(a), rows):
        far = np.bitwise_count(a[at : at + rows, None] ^ b[None, :])
        i, j = np.nonzero((far <= radius) & (far > 0))
        for x, y in zip(a[at + i].tolist(), b[j].tolist(), strict=True):
            p, q = root(x), root(y)
            if p != q:
                parent[p] = q
                out.append((x, y))
    return out


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (u, v) that join all distinct `fingerprint` values within `radius` of each other."""
    cell = sum((F.shiftleft(_quarter(k) + radius, 6 * k) for k in range(4)), F.lit(0))
    cells = prints.select("fingerprint").distinct().withColumn("cell", cell)
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    tiles = (
        cells.join(sizes, "cell")
        .withColumn("tile", F.pmod(F.xxhash64("fingerprint"), F.col("tiles")))
        .groupBy("cell", "tile")
        .agg(F.collect_list("fingerprint").alias("members"))
    )
    tiles = materialize(tiles, "tiles")
    steps = F.array(*[F.lit(s) for s in _cell_steps(radius)])
    left = tiles.select(
        F.col("cell").alias("from_cell"),
        F.col("tile").alias("from_tile"),
        F.col("members").alias("a"),
        F.explode(F.transform(steps, lambda s: F.col("cell") + s)).alias("cell"),
    )
    pairs = left.join(tiles.withColumnRenamed("members", "b"), "cell").where(
        (F.col("from_cell") != F.col("cell")) | (F.col("from_tile") <= F.col("tile"))
    )

    def compare(batches):
        for batch in batches:
            u, v = [], []
            sides = [batch.column(k) for k in ("a", "b")]
            for row in range(batch.num_rows):
                a, b = (
                    s[row].values.to_numpy(zero_copy_only=False).view(np.uint64) for s in sides
                )
                for x, y in forest(a, b, radius):
                    u.append(x)
                    v.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (u, v)], ["u", "v"]
            )

    ship(prints.sparkSession)
    return pairs.select("a", "b").mapInArrow(compare, "u bigint, v bigint")


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One half of a round: neighbours move to the least node that a node sees.

    The least neighbour is an aggregate and the move is a join, so a node with very many
    neighbours is never gathered in one place.
    """
    if large:
        both = edges.union(edges.select("v", "u")).toDF("n", "m")
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("r"))
        moved = both.join(least, "n").where("m > n").select(F.col("m").alias("u"), F.col("r").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("n"), F.least("u", "v").alias("m"))
        least = down.groupBy("n").agg(F.min("m").alias("r"))
        moved = (
            down.join(least, "n")
            .select(F.col("m").alias("u"), F.col("r").alias("v"))
            .union(least.select("n", "r"))
        )
    return moved.where("u != v").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(u, v): v is the least node of u's component; least nodes themselves are left out."""

    def state(df):
        return df.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint"))).first()

    edges = materialize(edges.where("u != v").distinct(), "edges")
    before = state(edges)
    if not before[0]:
        return edges
    for _ in range(most_rounds):
        edges = materialize(_stars(_stars(edges, large=True), large=False), "edges")
        now = state(edges)
        if now == before:
            return edges
        before = now
    raise RuntimeError(f"no components after {most_rounds} rounds")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (long) and component_id, the least doc_id reachable over links."""
    prints = materialize(fingerprints(docs, shingle), "prints")
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc"))
    roots = components(links(prints, radius))
    linked = first.join(
        roots.select(F.col("u").alias("fingerprint"), F.col("v").alias("root")), "fingerprint", "left"
    ).withColumn("root", F.coalesce("root", "fingerprint"))
    least = linked.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    found = linked.join(least, "root").select("fingerprint", "component_id")
    return prints.join(found, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_digits(column: str):
    """A long as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
