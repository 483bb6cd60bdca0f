"""Cross-tokenizer alignment: how often tokens of two vocabularies end together, over a corpus.

Both tokenizers encode each text; a token of side A and one of side B are linked if they end at the
same byte. Offsets where both end cut the text into groups.

Counting is external. Documents are taken in chunks of bounded size. A chunk's pair-document records
are dealt by the low bits of the B id into `RADICES` runs, each ordered by (B id, A id, document) and
written, compressed with zstd in frames, to the shared folder: a run's pairs with their sums in one
column, the documents of each pair in another. Up to `TOGETHER` runs of a radix are merged with a
k-way heap over their pairs, frame by frame, and rounds of merges leave one run for each radix: the
count of each pair. In side-major order all pairs of a B id stand together, so one scan finds their
highest count. The counts stream back to the runs, some chunks at a time, where every record adds to
its document. A pair that is in every document is one entry for each
run, so no task gets all its records; merged runs hold different pairs only, which the vocabularies
bound.

Texts are encoded by units: a space that follows another character and precedes a visible one begins a
unit. No token of either side crosses such a place (side A splits there; side B has no piece with a
space after another character, which is checked), so units are encoded and aligned once per worker.

Null and empty texts, and those whose tokens of either side don't spell a space and the text, have no
tokens: zeros and an empty group string. Repeated rows and null ids are documents of their own. Texts of
any length are encoded whole, unit by unit. Ties of the highest count all count as best. An
empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import materialize, parts_for, ship, text_or_empty

#: Bytes of text and documents of a chunk, about.
CHUNK_BYTES, CHUNK_DOCS = 4_000_000, 20_000
#: Runs of a chunk; a power of two.
RADICES = 16
#: Runs merged together, and chunks whose runs get their counts together.
TOGETHER = 64
#: Pairs of a frame.
FRAME = 4096
#: Units a Python worker remembers, about, and units encoded in one go.
REMEMBERED, AT_ONCE = 400_000, 4000
#: A pair's code is its B id and its A id; a record's key is the code and the document's place.
A_BITS, B_BITS, PLACE_BITS = 20, 22, 21

_UNIT = re.compile(r"(?<! ) (?=\S)")


def units(text: str) -> list[str]:
    """The text after a space, cut before every single space between other characters."""
    first, *rest = _UNIT.split(" " + text)
    return ([first] if first else []) + [" " + r for r in rest]


def _letters() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes are themselves, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _counts(lists: list) -> np.ndarray:
    return np.fromiter(map(len, lists), np.int64, len(lists))


def _flat(lists: list, counts: np.ndarray) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum()))


class Sides:
    """Both tokenizers, the bytes of their tokens, and what units give."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces of side B cross units")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        letter = _letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            mapped = [letter.get(c) for c in token]
            self.bytes_a[i] = token.encode() if None in mapped else bytes(mapped)
        if len(self.bytes_a) > 1 << A_BITS or len(self.bytes_b) > 1 << B_BITS:
            raise ValueError("vocabularies are too large for the pair codes")
        self.size_a, self.size_b = _counts(self.bytes_a), _counts(self.bytes_b)
        # ids as text with what follows them: inside a group, at its end, at the end of a unit
        self.text_a = [np.array([f"{k}{c}" for k in range(len(self.bytes_a))], object) for c in ",|"]
        self.text_b = [np.array([f"{k}{c}" for k in range(len(self.bytes_b))], object) for c in ",;\n"]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_a = self.n_b = self.n_links = self.links = _NONE

    def _encode(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides for all units in a row, how many each unit has, and whether it is spelt.

        Plain units are encoded many at a time, as no token crosses from one to the next.
        """
        raw = [u.encode() for u in new]
        odd = [u[1:2].isspace() or u[-1].isspace() or "▁" in u for u in new]
        blocks, sizes, held = [], [], AT_ONCE
        for unit, alone in zip(new, odd, strict=True):
            if alone or held >= AT_ONCE:
                blocks.append([])
                held = AT_ONCE if alone else 0
            blocks[-1].append(unit)
            held += 1
        texts = ["".join(b) for b in blocks]
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] for t in texts], num_threads=1)
        ends = np.cumsum(_counts(raw))
        found, spelt = [], np.ones(len(new), bool)
        for ids, names, lengths in ((ids_a, self.bytes_a, self.size_a), (ids_b, self.bytes_b, self.size_b)):
            flat = _flat(ids, _counts(ids))
            at = np.cumsum(lengths[flat])
            if b"".join(map(names.__getitem__, flat.tolist())) == b"".join(raw):
                found.append((flat, np.diff(np.searchsorted(at, ends, "right"), prepend=0)))
                continue
            # some unit is not spelt: each by itself
            single = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)] if ids is ids_a else (
                self.b.encode([u[1:] for u in new], num_threads=1)
            )
            spelt &= [b"".join(map(names.__getitem__, i)) == r for i, r in zip(single, raw, strict=True)]
            found.append((_flat(single, _counts(single)), _counts(single)))
        (a, n_a), (b, n_b) = found
        return a, n_a, b, n_b, spelt

    def learn(self, new: list[str]) -> None:
        """Aligns units; those that a side spells as another text get -1 tokens."""
        a, n_a, b, n_b, spelt = self._encode(new)
        if not spelt.all():
            a, b = a[np.repeat(spelt, n_a)], b[np.repeat(spelt, n_b)]
        each_a, each_b = n_a[spelt], n_b[spelt]
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        both_a, both_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        group_a, group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
        n_groups = int(both_a.sum())
        of_a, of_b = (np.cumsum(np.bincount(g, minlength=n_groups)) for g in (group_a, group_b))
        # a group's ids of side A come before those of side B
        place_a = np.arange(len(a)) + np.concatenate([[0], of_b])[group_a]
        place_b = np.arange(len(b)) + of_a[group_b]
        words = np.empty(len(a) + len(b), object)
        words[place_a] = np.where(both_a, self.text_a[1][a], self.text_a[0][a])
        words[place_b] = np.where(both_b, self.text_b[1][b], self.text_b[0][b])
        last = np.cumsum(each_b) - 1
        words[place_b[last]] = self.text_b[2][b[last]]
        groups = iter("".join(words.tolist()).split("\n"))
        inside = np.concatenate([[0], np.cumsum(both_a)])
        stops = np.cumsum(each_a)
        n_links = np.zeros(len(new), np.int64)
        n_links[spelt] = inside[stops] - inside[stops - each_a]
        self.known.update(zip(new, range(len(self.groups), len(self.groups) + len(new)), strict=True))
        self.groups += [next(groups) if ok else "" for ok in spelt.tolist()]
        self.n_a = np.concatenate([self.n_a, np.where(spelt, n_a, -1)])
        self.n_b = np.concatenate([self.n_b, np.where(spelt, n_b, -1)])
        self.n_links = np.concatenate([self.n_links, n_links])
        self.links = np.concatenate([self.links, b[both_b] << A_BITS | a[both_a]])

    def align(self, texts: list[str | None]) -> list[tuple]:
        """(n_a, n_b, groups as text, links as pair codes) of each text."""
        if len(self.known) > REMEMBERED:
            self.forget()
        split = [units(t) if t else [] for t in texts]
        every = list(itertools.chain.from_iterable(split))
        new = list(dict.fromkeys(u for u in every if u not in self.known))
        if new:
            self.learn(new)
        at = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        bounds = np.concatenate([[0], np.cumsum(_counts(split))])
        sums = [np.concatenate([[0], np.cumsum(x[at])]) for x in (self.n_a, self.n_b, self.n_links, self.n_a < 0)]
        n_a, n_b, n_links, unspelt = (x[bounds[1:]] - x[bounds[:-1]] for x in sums)
        starts = (np.cumsum(self.n_links) - self.n_links)[at]
        each = self.n_links[at]
        ends = np.cumsum(each)
        links = self.links[np.repeat(starts - (ends - each), each) + np.arange(int(each.sum()))]
        names, to = self.groups, at.tolist()
        out = []
        for k, (i, j) in enumerate(itertools.pairwise(bounds.tolist())):
            if i == j or unspelt[k]:
                out.append((0, 0, "", _NONE))
                continue
            first = int(sums[2][i])
            groups = ";".join(map(names.__getitem__, to[i:j]))
            out.append((int(n_a[k]), int(n_b[k]), groups, links[first : first + int(n_links[k])]))
        return out


_NONE = np.zeros(0, np.int64)


_sides: dict[tuple[str, str], Sides] = {}


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers, compressed."""
    return zstandard.compress(b"".join(a.astype("<i8").tobytes() for a in arrays), 3)


def _unpacked(data: bytes, n: int) -> list[np.ndarray]:
    """The `n` equally long arrays."""
    return list(np.frombuffer(zstandard.decompress(data), "<i8").reshape(n, -1))


def _frames(codes: np.ndarray, sums: np.ndarray) -> list[bytes]:
    return [
        _packed(np.diff(codes[i : i + FRAME], prepend=0), sums[i : i + FRAME])
        for i in range(0, len(codes), FRAME)
    ]


def _pairs(frames: list[bytes]) -> Iterator[tuple[int, int]]:
    """(code, sum) of a run, one frame unpacked at a time."""
    for frame in frames:
        steps, sums = _unpacked(frame, 2)
        yield from zip(np.cumsum(steps).tolist(), sums.tolist(), strict=True)


def _whole(frames: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [_unpacked(f, 2) for f in frames]
    return (
        np.concatenate([_NONE, *(np.cumsum(s) for s, _ in parts)]),
        np.concatenate([_NONE, *(n for _, n in parts)]),
    )


_ROW = (
    "chunk bigint, radix int, place int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, "
    "n_links bigint, groups string, frames array<binary>, records binary"
)
_TYPES = {
    "chunk": pa.int64(), "radix": pa.int32(), "place": pa.int32(), "doc_id": pa.int64(),
    "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
    "groups": pa.string(), "frames": pa.list_(pa.binary()), "records": pa.binary(),
}


def _batch(columns: dict) -> pa.RecordBatch:
    n = len(columns["chunk"])
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(k, [None] * n), t) for k, t in _TYPES.items()], list(_TYPES)
    )


def _runs(chunk: int, links: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The runs of a chunk, given the links of its documents."""
    place = np.repeat(np.arange(len(links)), _counts(links))
    keys = np.sort(np.concatenate([_NONE, *links]) << PLACE_BITS | place)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, n = keys[first], np.diff(np.append(first, len(keys)))
    radix = keys >> PLACE_BITS + A_BITS & RADICES - 1
    for r in range(RADICES):
        own = np.flatnonzero(radix == r)
        if len(own):
            codes, doc, count = keys[own] >> PLACE_BITS, keys[own] & (1 << PLACE_BITS) - 1, n[own]
            starts = np.flatnonzero(np.diff(codes, prepend=-1))
            frames = _frames(codes[starts], np.add.reduceat(count, starts))
            steps = np.zeros(len(own), np.int64)
            steps[starts[1:]] = 1
            yield _batch(
                {"chunk": [chunk], "radix": [r], "frames": [frames], "records": [_packed(steps, doc, count)]}
            )


def _encoded(docs: DataFrame, path_a: str, path_b: str, kept: Callable[[str], str]) -> DataFrame:
    """A row for each document (`place` in its chunk) and one for each run (`radix`)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path_a, path_b) not in _sides:
            _sides[path_a, path_b] = Sides(path_a, path_b)
        sides = _sides[path_a, path_b]
        chunk, held, links = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            step = max(1, batch.num_rows * 1_000_000 // max(1, batch.nbytes))
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                found = sides.align(part.column("text").to_pylist())
                yield _batch(
                    {
                        "chunk": [chunk] * len(found),
                        "place": range(len(links), len(links) + len(found)),
                        "doc_id": part.column("doc_id").to_pylist(),
                        "n_a": [f[0] for f in found],
                        "n_b": [f[1] for f in found],
                        "n_groups": [f[2].count("|") for f in found],
                        "n_links": [len(f[3]) for f in found],
                        "groups": [kept(f[2]) for f in found],
                    }
                )
                links += [f[3] for f in found]
                held += part.nbytes
                if held >= CHUNK_BYTES or len(links) >= CHUNK_DOCS:
                    yield from _runs(chunk, links)
                    chunk, held, links = chunk + 1, 0, []
        if links:
            yield from _runs(chunk, links)

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(work, _ROW)


def _merged(runs: Iterator[list[bytes]]) -> Iterator[tuple[int, int]]:
    """(code, count) in order, from runs of (code, sum), by a heap over their first pairs."""
    code, count = None, 0
    for c, n in heapq.merge(*map(_pairs, runs)):
        if c != code:
            if code is not None:
                yield code, count
            code, count = c, 0
        count += n
    if code is not None:
        yield code, count


def _run_of(pairs: Iterator[tuple[int, int]]) -> list[bytes]:
    """Frames of a run, one made at a time."""
    frames, codes, sums = [], [], []
    for code, n in pairs:
        codes.append(code)
        sums.append(n)
        if len(codes) == FRAME:
            frames += _frames(np.array(codes), np.array(sums))
            codes, sums = [], []
    return frames + (_frames(np.array(codes), np.array(sums)) if codes else [])


def _counted(runs: DataFrame, chunks: int) -> DataFrame:
    """radix, frames: one run for each radix with the counts of all its pairs."""
    schema = "radix int, slice bigint, frames array<binary>"

    def work(table: pa.Table) -> pa.Table:
        frames = _run_of(_merged(table.column("frames").to_pylist()))
        return pa.table(
            {
                "radix": table.column("radix")[:1],
                "slice": table.column("slice")[:1],
                "frames": pa.array([frames], pa.list_(pa.binary())),
            }
        )

    runs = runs.select("radix", F.xxhash64("chunk").alias("slice"), "frames")
    while True:
        chunks = parts_for(chunks, TOGETHER)
        runs = (
            runs.withColumn("slice", F.pmod("slice", F.lit(chunks)))
            .groupBy("radix", "slice")
            .applyInArrow(work, schema)
        )
        if chunks == 1:
            return runs.select("radix", "frames")


def _given_back(runs: DataFrame, counted: DataFrame, chunks: int) -> DataFrame:
    """chunk, place, n_best, count_sum of the documents that have records in a run."""
    slices = parts_for(chunks, TOGETHER)
    schema = "chunk bigint, place int, n_best bigint, count_sum bigint"

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, counts = _whole(right.column("frames")[0].as_py())
        first = np.flatnonzero(np.diff(codes >> A_BITS, prepend=-1))
        highest = np.maximum.reduceat(counts, first)
        best = counts == np.repeat(highest, np.diff(np.append(first, len(codes))))
        out = {"chunk": [], "place": [], "n_best": [], "count_sum": []}
        for chunk, frames, records in zip(
            *(left.column(k).to_pylist() for k in ("chunk", "frames", "records")), strict=True
        ):
            at = np.searchsorted(codes, _whole(frames)[0])
            steps, doc, n = _unpacked(records, 3)
            pair = at[np.cumsum(steps)]
            own, place = np.unique(doc, return_inverse=True)
            n_best, total = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
            np.add.at(n_best, place, n * best[pair])
            np.add.at(total, place, n * counts[pair])
            for k, v in zip(out, (np.full(len(own), chunk), own, n_best, total), strict=True):
                out[k].append(v)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table(
            {k: pa.array(np.concatenate([_NONE, *v]), t) for (k, v), t in zip(out.items(), kinds, strict=True)}
        )

    left = runs.select("chunk", "radix", "frames", "records").withColumn(
        "slice", F.pmod(F.xxhash64("chunk"), F.lit(slices))
    )
    right = counted.withColumn("slice", F.explode(F.sequence(*(F.lit(x).cast("bigint") for x in (0, slices - 1)))))
    return (
        left.groupBy("radix", "slice")
        .cogroup(right.groupBy("radix", "slice"))
        .applyInArrow(work, schema)
        .groupBy("chunk", "place")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )


def align(docs: DataFrame, path_a: str, path_b: str, kept: Callable[[str], str] = str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (`a1,a2|b1;a3|b2,b3`).

    `path_a` is a byte-level file of the `tokenizers` library that splits before spaces, `path_b` a
    `sentencepiece` model that puts a space before the text. `kept` says what is kept of the
    groups of a document, which are longer than its text, before rows are written and shuffled.
    """
    encoded = materialize(_encoded(docs, path_a, path_b, kept), "alignment")
    runs = encoded.where("radix is not null")
    chunks = runs.select("chunk").distinct().count()
    counted = materialize(_counted(runs, chunks), "pair-counts")
    back = _given_back(runs, counted, chunks)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    return (
        encoded.where("radix is null")
        .select("chunk", "place", *columns)
        .join(back, ["chunk", "place"], "left")
        .select(
            *columns[:-1],
            F.coalesce("n_best", F.lit(0)).alias("n_best"),
            F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
            "groups",
        )
    )
