"""Repeated substrings: every byte covered by a string of `length` bytes that starts elsewhere too.

Windows are brought together without sorting all suffixes of the corpus. Of the hashes of the
48-byte strings inside a window of `length` bytes the least is the window's anchor: equal windows
have equal anchors at equal places. A document's windows fall into runs with one anchor each,
about one run for 180 bytes, and only runs are shuffled, by anchor:

* runs of equal bytes (copies, the inside of shared passages) repeat whole;
* the other runs whose anchor occurs in different bytes meet in groups of bounded size, where a
  suffix array finds their repeated windows: suffixes smaller than their successor are sorted
  directly, the others induced by scans over the buckets, and neighbours are compared;
* an anchor in more different runs than a group holds (a line that very many documents share at
  the edges of different text) has its windows compared by their hashes, in blocks dealt by hash.

Anchors and runs that very many rows have are joined in parts, so no task gets all rows of one.

Null text is an empty document. Each row is a document of its own, even if ids repeat. Bytes are
judged on the input. Texts of any length are judged whole, some windows at a time. Of equal least hashes in a
window the first is its anchor. An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import map_batches, materialize, parts_for, ship, text_or_empty, with_rows
from linepulse.operators.skew import SALT, Salting

#: Bytes whose hashes are compared to choose an anchor.
GRAM = 48
#: Bytes sorted together, and different runs of one anchor that still go to a group.
SORTED_BYTES, MOST_RUNS = 1 << 18, 1000
#: A key with more than 1 of HOT rows is joined in that many parts.
HOT, PARTS = 512, 64
#: Windows of a text looked at together.
AT_ONCE = 1 << 20
#: Documents that are Python objects at once.
DOCS_AT_ONCE = 512


def _grams(raw: np.ndarray) -> np.ndarray:
    """64-bit hashes of all strings of GRAM bytes."""
    two = raw[:-1].astype(np.uint64) | raw[1:].astype(np.uint64) << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    eight = four[:-4] | four[4:] << np.uint64(32)
    n = len(raw) - GRAM + 1
    out = np.zeros(n, np.uint64)
    for k in range(GRAM // 8):
        out += eight[8 * k : 8 * k + n]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def runs(text: bytes, length: int):
    """(first window, last window, hash of the anchor) for each run of windows with one anchor."""
    raw = np.frombuffer(text, np.uint8)
    grams = length - GRAM + 1
    for at in range(0, max(0, len(raw) - length + 1), AT_ONCE):
        part = raw[at : at + AT_ONCE + length - 1]
        hashes = _grams(part)
        low = np.uint64((1 << 24) - 1)
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        span = 1
        while 2 * span <= grams:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < grams:
            least = np.minimum(least[: len(least) - (grams - span)], least[grams - span :])
        place = (least & low).astype(np.int64)
        edge = np.flatnonzero(np.diff(place))
        first = np.concatenate([[0], edge + 1])
        last = np.concatenate([edge, [len(place) - 1]])
        yield first + at, last + at, hashes[place[first]]


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """row, anchor, digest (of the run's bytes), first window and size in bytes of each run."""

    def work(batches):
        for batch in batches:
            for at in range(0, len(batch["text"]), 64):
                out = {k: [] for k in ("row", "anchor", "digest", "first", "size")}
                rows = batch["row"][at : at + 64]
                for row, text in zip(rows, batch["text"][at : at + 64], strict=True):
                    raw = text.encode()
                    for first, last, anchor in runs(raw, length):
                        out["row"] += [row] * len(first)
                        out["anchor"] += anchor.view(np.int64).tolist()
                        out["first"] += first.tolist()
                        out["size"] += (last - first + length).tolist()
                        out["digest"] += [
                            xxhash.xxh3_128_digest(raw[i : j + length])
                            for i, j in zip(first.tolist(), last.tolist(), strict=True)
                        ]
                yield out

    return map_batches(
        docs.select("row", "text"),
        "row bigint, anchor bigint, digest binary, first bigint, size bigint",
        work,
        DOCS_AT_ONCE,
    )


def _smaller_than_next(raw: np.ndarray) -> np.ndarray:
    """For each place: is its suffix smaller than the next one (the last place is)?"""
    step = np.append(np.sign(np.diff(raw.astype(np.int16))), 1)
    decided = np.where(step != 0, np.arange(len(step)), len(step))
    decided = np.minimum.accumulate(decided[::-1])[::-1]  # the next place that differs
    return step[decided] > 0


def _sorted_places(text: bytes, places: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their first `depth` bytes (eight at least), then of the places (which ascend).

    Their first eight bytes are sorted as numbers; only places that agree in them have the rest cut out of
    the text, one set of such places at a time, so that memory doesn't hold `depth` bytes for each place.
    """
    first = np.ndarray((len(text),), ">u8", text + bytes(7), strides=(1,))[places].astype(np.uint64)
    order = np.argsort(first, kind="stable")
    places, first = places[order], first[order]
    edge = np.flatnonzero(np.diff(first)) + 1
    start, stop = np.concatenate([[0], edge]), np.concatenate([edge, [len(first)]])
    alike = stop - start > 1
    for i, j in zip(start[alike].tolist(), stop[alike].tolist(), strict=True):
        places[i:j] = sorted(places[i:j].tolist(), key=lambda p: text[p : p + depth])
    return places


def suffix_order(text: bytes, needed: np.ndarray, depth: int) -> np.ndarray:
    """The `needed` places in the order of their suffixes, up to `depth` bytes at least.

    Two stages: the suffixes smaller than their successor are sorted, all others are induced. A
    scan goes over the buckets of first bytes upwards; each suffix put in order puts the one
    before it, if that is larger, at the next place of its own bucket.
    """
    raw = np.frombuffer(text, np.uint8)
    small = _smaller_than_next(raw)
    # up to the next small suffix, from which the larger ones before it are induced
    places = np.arange(len(raw))
    stop = np.minimum.accumulate(np.where(small, places, len(raw))[::-1])[::-1]
    ends = np.unique(stop[needed])
    held = np.zeros(len(raw), bool)
    held[needed] = True
    breaks = np.zeros(len(raw) + 1, np.int32)
    np.add.at(breaks, needed, 1)
    np.add.at(breaks, stop[needed] + 1, -1)
    held = np.cumsum(breaks[:-1]) > 0
    held[ends] = True
    direct = _sorted_places(text, np.flatnonzero(held & small), depth)
    first = raw[direct]
    waiting: dict[int, list[np.ndarray]] = {}
    larger = held & ~small
    order = []

    def pass_on(done: np.ndarray, above: int) -> np.ndarray:
        """Puts larger suffixes before those done into their buckets; returns those of `above`."""
        before = done[done > 0] - 1
        before = before[larger[before]]
        letters = raw[before]
        for c in np.unique(letters[letters > above]):
            waiting.setdefault(int(c), []).append(before[letters == c])
        return before[letters == above]

    for c in np.unique(raw[held]).tolist():
        bucket = np.concatenate(waiting.pop(c, [np.empty(0, np.int64)]))
        while len(bucket):
            order.append(bucket)
            bucket = pass_on(bucket, c)
        bucket = direct[np.searchsorted(first, c) : np.searchsorted(first, c, "right")]
        order.append(bucket)
        pass_on(bucket, c)
    found = np.concatenate(order)
    wanted = np.zeros(len(raw), bool)
    wanted[needed] = True
    return found[wanted[found]]


def common_prefixes(text: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """How many bytes, up to `most`, each suffix has in common with the one before it in `order`.

    All neighbours are compared together, eight bytes at a time, until they differ.
    """
    # eight bytes from every place on, as one number
    eight = np.ndarray((len(text),), "<u8", text + bytes(most + 8), strides=(1,))
    one, other = order[:-1], order[1:]
    out, alike = np.full(len(one), most), np.arange(len(one))
    for at in range(0, most, 8):
        differ = eight[np.minimum(one[alike] + at, len(text) - 1)] ^ eight[np.minimum(other[alike] + at, len(text) - 1)]
        ends = differ != 0
        low = differ[ends]
        zeros = np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1))  # below the lowest bit that differs
        out[alike[ends]] = at + (zeros.astype(np.int64) >> 3)
        alike = alike[~ends]
    return np.minimum(out, most)


def repeated(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part: which of its windows (strings of `length` bytes) occur elsewhere in parts."""
    text = b"\xff".join(parts) + b"\xff"  # no byte of UTF-8
    offsets = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
    counts = [max(0, len(p) - length + 1) for p in parts]
    needed = np.concatenate(
        [o + np.arange(n) for o, n in zip(offsets, counts, strict=True)] or [np.empty(0, int)]
    ).astype(np.int64)
    if not len(needed):
        return [np.zeros(n, bool) for n in counts]
    order = suffix_order(text, needed, length)
    equal = np.concatenate([[False], common_prefixes(text, order, length) >= length, [False]])
    marked = np.zeros(len(text), bool)
    marked[order] = equal[:-1] | equal[1:]
    return [marked[o : o + n] for o, n in zip(offsets, counts, strict=True)]


def _ranges(flags: np.ndarray, length: int):
    """Byte ranges (from, to) covered by the flagged windows."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1 + length) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _in_groups(parts: DataFrame, length: int) -> DataFrame:
    """Repeated ranges (row, start, stop) of runs, found by a suffix array for each group."""
    total = parts.agg(F.sum("size")).first()[0] or 0
    groups = parts_for(total, SORTED_BYTES)

    def work(table: pa.Table) -> pa.Table:
        out = {"row": [], "start": [], "stop": []}
        flags = repeated(table.column("part").to_pylist(), length)
        for row, first, n, flag in zip(
            *(table.column(k).to_pylist() for k in ("row", "first", "n")), flags, strict=True
        ):
            if n == 1:  # others repeat whole
                for start, stop in _ranges(flag, length):
                    out["row"].append(row)
                    out["start"].append(first + start)
                    out["stop"].append(first + stop)
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    ship(parts.sparkSession)
    return (
        parts.withColumn("group", F.pmod(F.xxhash64("anchor"), F.lit(groups)))
        .select("group", "row", "first", "n", "part")
        .groupBy("group")
        .applyInArrow(work, "row bigint, start bigint, stop bigint")
    )


def _window_hashes(parts: list[bytes], length: int, buckets: int):
    """128-bit hashes of all windows of parts, and for each bucket the places of its hashes."""
    found = b"".join(
        xxhash.xxh3_128_digest(p[i : i + length]) for p in parts for i in range(len(p) - length + 1)
    )
    hashes = np.frombuffer(found, "<u8").reshape(-1, 2)
    own = (hashes[:, 0] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    edges = np.searchsorted(own[order], np.arange(buckets + 1))
    return hashes, [order[i:j] for i, j in zip(edges[:-1], edges[1:], strict=True)]


def _by_hash(parts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many different runs: windows compared by 128-bit hashes.

    A batch of runs sends its windows' hashes, one block for each bucket of hashes; a bucket
    answers each block with flags, in the same order, for the hashes that it has twice.
    """
    ship(parts.sparkSession)
    windows = parts.agg(F.sum(F.col("size") - length + 1)).first()[0] or 0
    batches, buckets = parts_for(windows, 200_000), parts_for(windows, 1_000_000)
    parts = parts.withColumn("batch", F.pmod(F.xxhash64("row", "first"), F.lit(batches))).select(
        "batch", "row", "first", "n", "part"
    )
    block = "batch bigint, bucket int, data binary"

    def blocks(rows) -> pa.Table:
        names = ("batch", "bucket", "data")
        types = (pa.int64(), pa.int32(), pa.binary())
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
        )

    def ordered(table: pa.Table) -> pa.Table:
        return table.sort_by([("row", "ascending"), ("first", "ascending")])

    def send(table: pa.Table) -> pa.Table:
        table = ordered(table)
        hashes, places = _window_hashes(table.column("part").to_pylist(), length, buckets)
        batch = table.column("batch")[0].as_py()
        return blocks([(batch, b, hashes[at].tobytes()) for b, at in enumerate(places) if len(at)])

    def answer(table: pa.Table) -> pa.Table:
        data = [np.frombuffer(x, "<u8").reshape(-1, 2) for x in table.column("data").to_pylist()]
        both = np.concatenate(data)
        order = np.lexsort((both[:, 0], both[:, 1]))
        equal = np.concatenate([[False], (both[order[1:]] == both[order[:-1]]).all(axis=1), [False]])
        flags = np.zeros(len(both), np.uint8)
        flags[order] = equal[:-1] | equal[1:]
        own = np.split(flags, np.cumsum([len(x) for x in data])[:-1])
        where = zip(*(table.column(k).to_pylist() for k in ("batch", "bucket")), strict=True)
        return blocks([(x, b, f.tobytes()) for (x, b), f in zip(where, own, strict=True)])

    def receive(left: pa.Table, right: pa.Table) -> pa.Table:
        left = ordered(left)
        pieces = left.column("part").to_pylist()
        hashes, places = _window_hashes(pieces, length, buckets)
        flags = np.zeros(len(hashes), bool)
        for b, data in zip(*(right.column(k).to_pylist() for k in ("bucket", "data")), strict=True):
            flags[places[b]] = np.frombuffer(data, np.uint8)
        out, at = {"row": [], "start": [], "stop": []}, 0
        for row, first, n, part in zip(
            *(left.column(k).to_pylist() for k in ("row", "first", "n")), pieces, strict=True
        ):
            count = len(part) - length + 1
            for start, stop in _ranges(flags[at : at + count], length) if n == 1 else ():
                out["row"].append(row)
                out["start"].append(first + start)
                out["stop"].append(first + stop)
            at += count
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    answers = (
        parts.groupBy("batch").applyInArrow(send, block).groupBy("bucket").applyInArrow(answer, block)
    )
    return (
        parts.groupBy("batch")
        .cogroup(answers.groupBy("batch"))
        .applyInArrow(receive, "row bigint, start bigint, stop bigint")
    )


def _hot(counted: DataFrame, key: str) -> tuple[int, ...]:
    """The keys of a table of (key, n) that have more than 1 of `HOT` of all rows: fewer than `HOT`."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    return tuple(r[0] for r in counted.where(F.col("n") * HOT > total).select(key).distinct().collect())


def _join(
    left: DataFrame, right: DataFrame, on: list[str], key: str, hot: tuple[int, ...], how: str = "inner"
) -> DataFrame:
    """An equi-join in which the left rows of hot keys are spread over parts."""
    salting = Salting(hot, PARTS)
    joined = salting.spread(left, key).join(salting.repeat(right, key), [*on, SALT], how)
    return joined.drop(SALT)


def covered(docs: DataFrame, length: int = 400, most_runs: int | None = None) -> DataFrame:
    """Byte ranges (row, start, stop), maybe overlapping, that repeat. docs: row, text."""
    most_runs = MOST_RUNS if most_runs is None else most_runs
    found = materialize(anchors(docs, length), "anchors").withColumn("mark", F.xxhash64("digest"))
    again = found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    candidates = _join(found, again, ["anchor"], "anchor", _hot(again, "anchor"), "left_semi")
    found = materialize(candidates, "candidates")
    different = found.groupBy("anchor", "digest", "mark").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "first", "size")).alias("one")
    )
    different = materialize(different, "runs")
    repeated_runs = different.where("n > 1").select("anchor", "digest", "mark", "n")
    whole = _join(
        found, repeated_runs, ["anchor", "digest", "mark"], "mark", _hot(repeated_runs, "mark"), "left_semi"
    )
    kinds = different.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    many = _hot(kinds.withColumnRenamed("kinds", "n"), "anchor")
    picked = (
        _join(different, kinds, ["anchor"], "anchor", many)
        .select("one.*", "anchor", "n", (F.col("kinds") > most_runs).alias("hot"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("first", "size", "anchor", "n", "hot")).alias("picked"))
    )
    raw = F.col("text").cast("binary")
    parts = docs.join(picked, "row").select(
        "row",
        F.explode(
            F.transform(
                "picked",
                lambda p: F.struct(
                    p["first"].alias("first"),
                    p["size"].alias("size"),
                    p["anchor"].alias("anchor"),
                    p["n"].alias("n"),
                    p["hot"].alias("hot"),
                    F.substring(raw, (p["first"] + 1).cast("int"), p["size"].cast("int")).alias("part"),
                ),
            )
        ).alias("p"),
    )
    parts = materialize(parts.select("row", "p.*"), "parts")
    return (
        whole.select("row", F.col("first").alias("start"), (F.col("first") + F.col("size")).alias("stop"))
        .union(_in_groups(parts.where("not hot"), length))
        .union(_by_hash(parts.where("hot"), length))
    )


def cut(text: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The bytes outside all ranges, how many are inside, and in how many maximal runs."""
    kept, at, spans, removed = [], 0, 0, 0
    end = -1
    for start, stop in sorted(ranges):
        if start > end:
            spans += 1
            kept.append(text[at:start])
        begin = max(start, at)
        removed += max(0, stop - begin)
        at = end = max(stop, at)
    kept.append(text[at:])
    return b"".join(kept), removed, spans


def remove_repeats(docs: DataFrame, length: int = 400, most_runs: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every document."""
    docs = docs.withColumn("text", text_or_empty())
    docs = with_rows(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), "doc_id", "text")
    ranges = (
        covered(docs.select("row", "text"), length, most_runs)
        .groupBy("row")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    )

    def work(batches):
        for batch in batches:
            out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")}
            for doc, text, starts, stops in zip(
                *(batch[k] for k in ("doc_id", "text", "starts", "stops")), strict=True
            ):
                raw = text.encode()
                kept, removed, spans = cut(raw, list(zip(starts or [], stops or [], strict=True)))
                for k, v in zip(out, (doc, len(raw), removed, spans, kept), strict=True):
                    out[k].append(v)
            yield out

    return map_batches(
        docs.join(ranges, "row", "left").select("doc_id", "text", "starts", "stops"),
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary",
        work,
        DOCS_AT_ONCE,
    )
