"""Language-model scores: a probabilistic suffix tree over words, beside word counts.

The symbols are the words of a text and its end. The root is the add-0.5 distribution of the words;
a context of one or more words stands below the context without its farthest word. A context is
retained if it has occurred `EVIDENCE` times, `FURTHER` times as often for each further word, and a divergence test favours it: the logarithm of the Bayes
factor between "its next symbols have a distribution of their own, spread around the parent's" and "they
are the parent's" is beyond `BOUND`. Both are fixed numbers, so the tree grows with the corpus. The
distribution of a retained context is smoothed by its parent's, with a weight for each different symbol
that has followed it, and each symbol is scored from the longest retained suffix of what stands before.

Nothing of the tree is on the driver. Documents are taken in chunks; a chunk sends its different words
and then its different (context, symbol) pairs once, in sorted blocks dealt by hash; a pair goes with
the nats that its symbol costs after the parent. A bucket adds up the blocks of all chunks and answers
each in its order: totals of words; for pairs their count and, for each context, how often it occurred,
with how many different symbols, the log likelihood of those, and what their repeats cost after the parent.
A block never has more rows than entries, so this is at most an ordinary shuffle by key. Pairs of the
few contexts with a share beyond 1 / `HOT` are dealt by the pair, and their sums are brought together
on their own. Contexts of one word are counted where the word has the evidence, which its total tells.
A context of k + 1 words can only have the evidence if its first k + 1 words have it as a pair, which
round k has counted, so later rounds carry on those positions alone, until none or `LONGEST` words are left.

Words count by 64-bit hashes: of V different words two share a count with a chance of V^2 / 2^65.
Contexts and symbols of pairs are 32-bit hashes; those that collide share a distribution.

Null text is an empty document: one end symbol. Null ids are kept. Repeated rows are scored and
counted as often as they occur; nothing depends on ties. Texts of any length are whole, and a long one
is a chunk by itself. An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import materialize, parts_for, ship, text_or_empty

#: Text bytes and documents of a chunk, and text bytes of all chunks for one bucket, about.
CHUNK_BYTES, CHUNK_DOCS, BUCKET_BYTES = 8_000_000, 50_000, 24_000_000
#: Occurrences that a context of one word needs, nats that its test needs, weight of a different symbol.
EVIDENCE, BOUND, WEIGHT = 64, 8.0, 2.0
#: How many times as many a context of one more word needs.
FURTHER = 4
#: Words of the longest context.
LONGEST = 3
#: Contexts with more than 1 of HOT positions have their pairs spread.
HOT = 512
_END = b"\n"  # no word holds a line end
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit numbers scrambled."""
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(29)


def log_gamma(n: np.ndarray) -> np.ndarray:
    """log of (n - 1)! for whole n >= 1: a table, and Stirling's series for large ones."""
    n = np.asarray(n, float)
    small = np.minimum(n, len(_GAMMA) - 1).astype(np.int64)
    large = (n - 0.5) * np.log(n) - n + 0.5 * np.log(2 * np.pi) + 1 / (12 * n)
    return np.where(n < len(_GAMMA), _GAMMA[small], large)


_GAMMA = np.concatenate([[0.0, 0.0], np.cumsum(np.log(np.arange(1, 255)))])


def gain(n: np.ndarray, different: np.ndarray, likelihood: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Log Bayes factor, in nats, that contexts have a distribution of their own.

    The `n` next symbols are either drawn from the parent, where a symbol costs -log of its probability
    each time, or from a distribution that is spread around the parent's (a Dirichlet process as
    concentrated as there are different symbols): then each different symbol is paid for once. `cost`
    is what the parent asks for the other times: the sum of (count - 1) * -log probability over the
    symbols. `likelihood` is the sum of log (count - 1)! over them.
    """
    a = np.maximum(different, 1)
    own = different * np.log(a) + likelihood + log_gamma(a) - log_gamma(a + n)
    return own + cost


def probability(
    p: np.ndarray,
    count: np.ndarray,
    n: np.ndarray,
    different: np.ndarray,
    likelihood: np.ndarray,
    cost: np.ndarray,
    evidence: int,
) -> np.ndarray:
    """Probabilities of symbols after contexts, given those after their parents."""
    kept = (n >= evidence) & (gain(n, different, likelihood, cost) > BOUND)
    spread = WEIGHT * different
    return np.where(kept, (count + spread * p) / np.maximum(n + spread, 1), p)


# --- chunks -------------------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), 3)


def _unpack(data: bytes, *types: str) -> list[np.ndarray]:
    """The equally long arrays of `types`."""
    raw = zstandard.decompress(data)
    n, at, out = len(raw) // sum(np.dtype(t).itemsize for t in types), 0, []
    for t in types:
        out.append(np.frombuffer(raw, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


_CHUNK = "chunk bigint, docs binary, text binary, top binary, words binary"


def _chunks(docs: DataFrame) -> DataFrame:
    """Rows of documents in chunks, lower-cased and compressed, each with its most frequent words and the
    counts of all its words in training rows.
    """

    def packed(chunk: int, rows: list[tuple]) -> pa.RecordBatch:
        ids, learn, texts = zip(*rows, strict=True)
        known = np.array([i is not None for i in ids], "u1")
        docs = _pack(
            np.array([i or 0 for i in ids], "<i8"), np.array([len(t) for t in texts], "<i8"), known, np.array(learn, "u1")
        )
        words = _Words(list(texts), np.array(learn, bool))
        counts = np.bincount(words.token, minlength=len(words.hash))
        often = counts * HOT > len(words.token)
        top = _pack(words.hash[often] & _LOW, counts[often].astype("<i8"))
        order = np.argsort(words.hash)
        learnt = np.bincount(words.token, words.learn, len(words.hash)).astype("<i8")
        totals = _pack(np.diff(words.hash[order], prepend=np.uint64(0)), learnt[order])
        columns = ([chunk], [docs], [zstandard.compress(b"".join(texts), 6)], [top], [totals])
        types = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["chunk", "docs", "text", "top", "words"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, rows = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            for row in zip(*(batch.column(k) for k in ("doc_id", "learn", "text")), strict=True):
                text = row[2].as_py().encode().lower()
                rows.append((row[0].as_py(), row[1].as_py(), text))
                held += len(text)
                if held >= CHUNK_BYTES or len(rows) >= CHUNK_DOCS:
                    yield packed(chunk, rows)
                    chunk, held, rows = chunk + 1, 0, []
        if rows:
            yield packed(chunk, rows)

    return docs.mapInArrow(work, _CHUNK)


class _Words:
    """The tokens of the texts of a chunk: `token` numbers them, `hash` and `prev` are theirs."""

    def __init__(self, texts: list[bytes], learn: np.ndarray):
        split = [t.split() for t in texts]
        self.sizes = np.fromiter(map(len, split), np.int64, len(split)) + 1
        every = pa.array([w for words in split for w in (*words, _END)], pa.binary()).dictionary_encode()
        self.hash = np.fromiter(map(xxhash.xxh64_intdigest, every.dictionary.to_pylist()), np.uint64)
        self.token = every.indices.to_numpy().astype(np.int64)
        self.stops = np.cumsum(self.sizes)
        self.starts = self.stops - self.sizes
        self.learn = np.repeat(learn, self.sizes)
        half = self.hash[self.token] & _LOW
        before = np.empty_like(half)
        before[1:] = half[:-1]
        before[self.starts] = xxhash.xxh64_intdigest(_END) & 0xFFFFFFFF
        self.next, self.context = half, before


def _read(row) -> tuple[np.ndarray, np.ndarray, _Words]:
    """ids, whether they are known, and the words of a chunk row."""
    ids, sizes, known, learn = _unpack(row["docs"], "<i8", "<i8", "u1", "u1")
    text = zstandard.decompress(row["text"])
    ends = np.cumsum(sizes)
    texts = [text[i:j] for i, j in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
    return ids, known, _Words(texts, learn.astype(bool))


class _Keys:
    """The different keys of a chunk, in the order in which blocks send them."""

    def __init__(self, keys: np.ndarray, bucket: np.ndarray, buckets: int):
        order = np.argsort(bucket, kind="stable")
        self.keys = keys[order]
        self.place = np.empty(len(keys), np.int64)
        self.place[order] = np.arange(len(keys))
        self.edges = np.searchsorted(bucket[order], np.arange(buckets + 1))

    def slices(self) -> Iterator[tuple[int, slice]]:
        for b, (i, j) in enumerate(zip(self.edges[:-1].tolist(), self.edges[1:].tolist(), strict=True)):
            if i < j:
                yield b, slice(i, j)


def _word_keys(words: _Words, buckets: int) -> tuple[_Keys, np.ndarray]:
    """Word hashes, sorted inside their buckets, and the place of each of the chunk's words."""
    keys, at = np.unique(words.hash, return_inverse=True)
    made = _Keys(keys, _word_bucket(keys, buckets), buckets)
    return made, made.place[at]


def _word_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys % np.uint64(buckets)).astype(np.int64)


def _pair_keys(context: np.ndarray, symbol: np.ndarray, buckets: int, hot: np.ndarray) -> tuple[_Keys, np.ndarray]:
    """Pairs, sorted inside their buckets, and the place of each position's pair."""
    keys, at = np.unique(context << _HALF | symbol, return_inverse=True)
    owner = keys >> _HALF
    dealt = _mix(np.where(np.isin(owner, hot), keys, owner)) >> np.uint64(8)
    made = _Keys(keys, (dealt % np.uint64(buckets)).astype(np.int64), buckets)
    return made, made.place[at]


# --- blocks and answers -------------------------------------------------------------

_BLOCK = "kind int, chunk bigint, bucket int, keys binary, sums binary, costs binary"
_BLOCK_TYPES = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
WORDS, PAIRS = 0, 1


def _block_table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _BLOCK_TYPES, strict=True)],
        ["kind", "chunk", "bucket", "keys", "sums", "costs"],
    )


def _blocks(kind: int, chunk: int, keys: _Keys, counts: np.ndarray, costs: np.ndarray | None = None) -> list[tuple]:
    return [
        (
            kind,
            chunk,
            b,
            _pack(np.diff(keys.keys[own], prepend=np.uint64(0))),
            _pack(counts[own].astype("<i8")),
            None if costs is None else _pack(costs[own].astype("<f4")),
        )
        for b, own in keys.slices()
    ]


def _pair_blocks(chunk: int, context, symbol, learn, p, buckets: int, hot: np.ndarray) -> pa.Table:
    """Blocks of the pairs at some positions: counts in training rows, nats of the symbols after the parents."""
    made, at = _pair_keys(context, symbol, buckets, hot)
    costs = np.zeros(len(made.keys))
    np.maximum.at(costs, at, -np.log(p))  # the same at all positions of a pair but for colliding contexts
    return _block_table(_blocks(PAIRS, chunk, made, np.bincount(at, learn, len(made.keys)), costs))


def _sent_words(chunks: DataFrame, buckets: int) -> DataFrame:
    """Blocks of words with their counts in training rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, totals in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                steps, counts = _unpack(totals, "<u8", "<i8")
                keys = np.cumsum(steps)
                made = _Keys(keys, _word_bucket(keys, buckets), buckets)
                placed = np.empty_like(counts)
                placed[made.place] = counts
                yield from _block_table(_blocks(WORDS, chunk, made, placed)).to_batches()

    return chunks.select("chunk", "words").mapInArrow(work, _BLOCK)


def _word_counts(words: _Words, answers: dict[int, bytes], buckets: int) -> np.ndarray:
    """Totals of a chunk's words in training rows, from the answers to its blocks."""
    made, at = _word_keys(words, buckets)
    counts = np.zeros(len(made.keys), np.int64)
    for b, own in made.slices():
        counts[own] = _unpack(answers[b], "<i8")[0]
    return counts[at]


def _contexts_with(words: _Words, totals: np.ndarray, evidence: int) -> np.ndarray:
    """Positions whose context of one word has the evidence: a word is a context wherever it occurs."""
    count = totals[words.token]
    before = np.empty_like(count)
    before[1:] = count[:-1]
    before[words.starts] = totals[words.token[words.stops[0] - 1]]  # the end stands before the first word
    return np.flatnonzero(before >= evidence)


def _sent_pairs(chunks: DataFrame, answers: DataFrame, buckets: int, hot: np.ndarray, totals: tuple, evidence: int) -> DataFrame:
    """Blocks of pairs with contexts of one word that has the evidence."""
    tokens, different = totals
    least = float(np.log10(tokens + 0.5 * (different + 1)))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        _, _, words = _read(row)
        found = dict(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist(), strict=True))
        count = _word_counts(words, found, buckets)
        own = _contexts_with(words, count, evidence)
        p = 10.0 ** (np.log10(count + 0.5) - least)
        return _pair_blocks(
            row["chunk"], words.context[own], words.next[own], words.learn[own], p[words.token[own]], buckets, hot
        )

    return (
        chunks.select("chunk", "docs", "text")
        .groupBy("chunk")
        .cogroup(answers.select("chunk", "bucket", "data").groupBy("chunk"))
        .applyInArrow(work, _BLOCK)
    )


_ANSWER = "kind int, chunk bigint, bucket int, data binary, key bigint, a bigint, b bigint, c double, d double"
_ANSWER_TYPES = (
    pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
)


def _answer_table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * 9
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _ANSWER_TYPES, strict=True)],
        ["kind", "chunk", "bucket", "data", "key", "a", "b", "c", "d"],
    )


def _context_sums(keys: np.ndarray, counts: np.ndarray, costs: np.ndarray):
    """For sorted pairs: contexts, their occurrences, different symbols, log likelihoods and costs of repeats."""
    owner = keys >> _HALF
    first = np.flatnonzero(np.diff(owner, prepend=owner[0] ^ np.uint64(1)) != 0)
    seen = counts > 0
    return (
        owner[first],
        np.add.reduceat(counts, first),
        np.add.reduceat(seen.astype(np.int64), first),
        np.add.reduceat(np.where(seen, log_gamma(np.maximum(counts, 1)), 0.0), first),
        np.add.reduceat(np.maximum(counts - 1, 0) * costs, first),
    )


def _answered(blocks: DataFrame, hot: np.ndarray) -> DataFrame:
    """Answers to all blocks. Rows without a chunk: totals of words (tokens, different ones) and sums of
    hot contexts by bucket.
    """

    def work(table: pa.Table) -> pa.Table:
        kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
        chunks = table.column("chunk").to_pylist()
        keys = [np.cumsum(_unpack(k.as_py(), "<u8")[0]) for k in table.column("keys")]
        sizes = [len(k) for k in keys]
        keys = np.concatenate(keys)
        known, at = np.unique(keys, return_inverse=True)
        at = at.astype(np.int32 if len(known) < 1 << 31 else np.int64)
        sums, start = np.zeros(len(known), np.int64), 0
        for size, counts in zip(sizes, table.column("sums"), strict=True):
            sums[at[start : start + size]] += _unpack(counts.as_py(), "<i8")[0]  # a block's keys differ
            start += size
        out = []
        if kind == WORDS:
            n = sums[sums > 0]
            out.append((kind, None, bucket, None, None, int(n.sum()), len(n), None, None))
        else:
            costs, start = np.zeros(len(known), "<f4"), 0
            for size, sent in zip(sizes, table.column("costs"), strict=True):
                own = at[start : start + size]
                costs[own] = np.maximum(costs[own], _unpack(sent.as_py(), "<f4")[0])
                start += size
            owners, n, different, likelihood, cost = _context_sums(known, sums, costs.astype(float))
            is_hot = np.isin(owners, hot)
            for row in zip(*(x[is_hot].tolist() for x in (owners, n, different, likelihood, cost)), strict=True):
                out.append((kind, None, bucket, None, *row))
        start = 0
        for chunk, size in zip(chunks, sizes, strict=True):
            own, asked = at[start : start + size], keys[start : start + size]
            start += size
            data = _pack(sums[own].astype("<i8"))
            if kind == PAIRS:
                asked = np.unique(asked >> _HALF)
                place = np.searchsorted(owners, asked)
                about = [n[place].astype("<i8"), different[place].astype("<i8")]
                about += [likelihood[place].astype("<f4"), cost[place].astype("<f4")]
                data = len(data).to_bytes(8, "little") + data + _pack(*about)
            out.append((kind, chunk, bucket, data, None, None, None, None, None))
        pa.default_memory_pool().release_unused()
        return _answer_table(out)

    return blocks.groupBy("kind", "bucket").applyInArrow(work, _ANSWER)


def _pair_answers(keys: _Keys, answers: dict[int, bytes], hot_sums: dict) -> tuple[np.ndarray, ...]:
    """(count, occurrences, different symbols, likelihood, cost of repeats of the context) of each key, in order."""
    out = [np.zeros(len(keys.keys), t) for t in (np.int64, np.int64, np.int64, float, float)]
    for b, own in keys.slices():
        data = answers[b]
        cut = 8 + int.from_bytes(data[:8], "little")
        out[0][own] = _unpack(data[8:cut], "<i8")[0]
        about = _unpack(data[cut:], "<i8", "<i8", "<f4", "<f4")
        _, place = np.unique(keys.keys[own] >> _HALF, return_inverse=True)
        for column, values in zip(out[1:], about, strict=True):
            column[own] = values[place]
    if hot_sums["key"].size:
        owner = keys.keys >> _HALF
        at = np.minimum(np.searchsorted(hot_sums["key"], owner), hot_sums["key"].size - 1)
        is_hot = hot_sums["key"][at] == owner
        for column, name in zip(out[1:], "abcd", strict=True):
            column[is_hot] = hot_sums[name][at[is_hot]]
    return tuple(out)


# --- scores -------------------------------------------------------------------------

_SCORED = (
    "chunk bigint, place int, doc_id bigint, learn boolean, n_tokens bigint, n_known bigint, "
    "base_score double, score double, carry binary"
)
_SCORED_TYPES = (
    pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(),
)
_NAMES = [c.split()[0] for c in _SCORED.split(", ")]


def _scored_table(columns: dict, n: int) -> pa.Table:
    return pa.Table.from_arrays(
        [pa.array(columns.get(k, [None] * n), t) for k, t in zip(_NAMES, _SCORED_TYPES, strict=True)], _NAMES
    )


def _carried(place, doc, learn, context, symbol, p, count, evidence: int, last: bool) -> bytes | None:
    """The positions whose context can grow by a word: their pair of the next round and what they have now.

    A position's longer context is the context and symbol of the position before it.
    """
    if last or len(place) < 2:
        return None
    grows = (count[:-1] >= evidence) & (place[1:] == place[:-1] + 1) & (doc[1:] == doc[:-1])
    now, before = np.flatnonzero(grows) + 1, np.flatnonzero(grows)
    if not len(now):
        return None
    longer = _mix(context[before] << _HALF | symbol[before]) & _LOW
    columns = (np.diff(place[now], prepend=0), np.diff(doc[now], prepend=0), learn[now], longer, symbol[now], p[now])
    return _pack(*[c.astype(t) for c, t in zip(columns, _CARRY, strict=True)])


#: Steps between places and between documents, training flags, contexts, symbols, probabilities.
_CARRY = ("<i4", "<i4", "u1", "<u4", "<u4", "<f4")


def _unpack_carry(carry: bytes) -> tuple[np.ndarray, ...]:
    place, doc, learn, context, symbol, p = _unpack(carry, *_CARRY)
    place, doc = np.cumsum(place, dtype=np.int64), np.cumsum(doc, dtype=np.int64)
    return place, doc, learn.astype(bool), context.astype(np.uint64), symbol.astype(np.uint64), p.astype(float)


def _sums(answered: DataFrame, hot: np.ndarray) -> dict[str, np.ndarray]:
    """Sums of the hot contexts: fewer than HOT rows."""
    rows = (
        answered.where(f"chunk is null and kind = {PAIRS}")
        .groupBy("key")
        .agg(*[F.sum(name).alias(name) for name in "abcd"])
        .orderBy("key")
        .collect()
        if len(hot)
        else []
    )
    types = {"key": np.uint64, "a": np.int64, "b": np.int64, "c": float, "d": float}
    return {k: np.array([r[k] for r in rows], t) for k, t in types.items()}


def _first_scores(
    chunks: DataFrame,
    counted: DataFrame,
    answered: DataFrame,
    buckets: int,
    hot: np.ndarray,
    totals: tuple,
    evidence: int,
    last: bool,
) -> DataFrame:
    """Base columns, and scores with contexts of one word; carry rows for longer ones."""
    tokens, different = totals
    hot_sums, least = _sums(answered, hot), float(np.log10(tokens + 0.5 * (different + 1)))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        found: dict[int, dict[int, bytes]] = {WORDS: {}, PAIRS: {}}
        for kind, bucket, data in zip(*(right.column(k).to_pylist() for k in ("kind", "bucket", "data")), strict=True):
            found[kind][bucket] = data
        ids, known, words = _read(row)
        counts = _word_counts(words, found[WORDS], buckets)
        count = counts[words.token]
        logs = np.log10(count + 0.5) - least
        own = _contexts_with(words, counts, evidence)
        made, at = _pair_keys(words.context[own], words.next[own], buckets, hot)
        about = [x[at] for x in _pair_answers(made, found[PAIRS], hot_sums)]
        p = 10.0**logs
        p[own] = probability(p[own], *about, evidence)
        pairs = np.zeros(len(p), np.int64)
        pairs[own] = about[0]
        doc = np.repeat(np.arange(len(ids)), words.sizes)
        carry = _carried(np.arange(len(p)), doc, words.learn, words.context, words.next, p, pairs, FURTHER * evidence, last)
        n = len(ids)
        learn = words.learn[words.starts]
        out = {
            "chunk": [row["chunk"]] * n,
            "place": range(n),
            "doc_id": pa.array(ids, pa.int64(), mask=known == 0),
            "learn": learn,
            "n_tokens": words.sizes,
            "n_known": np.add.reduceat((count > 0).astype(np.int64), words.starts),
            "base_score": np.add.reduceat(logs, words.starts),
            "score": np.add.reduceat(np.log10(p), words.starts),
        }
        table = _scored_table(out, n)
        if carry is None:
            return table
        return pa.concat_tables([table, _scored_table({"chunk": [row["chunk"]], "carry": [carry]}, 1)])

    answers = counted.unionByName(answered).where("chunk is not null").select("kind", "chunk", "bucket", "data")
    return (
        chunks.select("chunk", "docs", "text")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(work, _SCORED)
    )


def _round(carried: DataFrame, buckets: int, evidence: int, last: bool) -> DataFrame:
    """What contexts of one more word add to the scores, and carry rows for still longer ones."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, carry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, _, learn, context, symbol, p = _unpack_carry(carry)
                yield from _pair_blocks(chunk, context, symbol, learn, p, buckets, _NO_KEYS).to_batches()

    def receive(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, carry = left.column("chunk")[0].as_py(), left.column("carry")[0].as_py()
        place, doc, learn, context, symbol, p = _unpack_carry(carry)
        made, at = _pair_keys(context, symbol, buckets, _NO_KEYS)
        found = dict(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist(), strict=True))
        about = [x[at] for x in _pair_answers(made, found, {"key": _NO_KEYS})]
        longer = probability(p, *about, evidence)
        own, to = np.unique(doc, return_inverse=True)
        added = np.bincount(to, np.log10(longer / p))
        table = _scored_table({"chunk": [chunk] * len(own), "place": own, "score": added}, len(own))
        more = _carried(place, doc, learn, context, symbol, longer, about[0], FURTHER * evidence, last)
        if more is None:
            return table
        return pa.concat_tables([table, _scored_table({"chunk": [chunk], "carry": [more]}, 1)])

    blocks = carried.select("chunk", "carry").mapInArrow(send, _BLOCK)
    answers = _answered(blocks, _NO_KEYS).where("chunk is not null").select("chunk", "bucket", "data")
    return carried.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(receive, _SCORED)


_NO_KEYS = np.zeros(0, np.uint64)


def _frequent(chunks: DataFrame) -> np.ndarray:
    """Hashes of the words with a share beyond 1 / HOT of the tokens, among those frequent in their chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for top in batch.column("top").to_pylist():
                keys, counts = _unpack(top, "<u8", "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.astype(np.int64)), pa.array(counts)], ["key", "n"]
                )

    rows = chunks.select("top").mapInArrow(work, "key bigint, n bigint")
    counted = rows.groupBy("key").agg(F.sum("n").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    found = counted.where(F.col("n") * HOT > total).select("key").orderBy("key").collect()
    return np.array([r[0] for r in found], np.uint64)


def score(
    docs: DataFrame, learn: Column, longest: int = LONGEST, evidence: int = EVIDENCE
) -> DataFrame:
    """doc_id, learn, n_tokens, n_known, train_tokens, base_score and score of all documents.

    `learn` is the condition on doc_id for the rows that are learnt from.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_or_empty().alias("text"),
        F.coalesce(learn, F.lit(True)).alias("learn"),
    )
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint") + 8)).first()[0] or 0
    buckets = parts_for(size, BUCKET_BYTES, 8)
    chunks = materialize(_chunks(rows), "chunks")
    hot = _frequent(chunks)
    counted = materialize(_answered(_sent_words(chunks, buckets), hot), "words")
    tokens, different = (x or 0 for x in counted.where("chunk is null").agg(F.sum("a"), F.sum("b")).first())
    totals = (tokens, different)
    sent = _sent_pairs(chunks, counted.where("chunk is not null"), buckets, hot, totals, evidence)
    answered = materialize(_answered(sent, hot), "counts")
    scored = _first_scores(chunks, counted, answered, buckets, hot, totals, evidence, longest < 2)
    if longest > 1:
        scored = materialize(scored, "scores")
    docs, added = scored.where("carry is null"), None
    carried = scored.where("carry is not null").select("chunk", "carry")
    for words in range(2, longest + 1):
        if not carried.limit(1).count():
            break
        enough = evidence * FURTHER ** (words - 1)
        made = materialize(_round(carried, buckets, enough, words == longest), "scores")
        more = made.where("carry is null").select("chunk", "place", F.col("score").alias("more"))
        added = more if added is None else added.unionByName(more)
        carried = made.where("carry is not null").select("chunk", "carry")
    if added is not None:
        sums = added.groupBy("chunk", "place").agg(F.sum("more").alias("more"))
        docs = docs.join(sums, ["chunk", "place"], "left").withColumn(
            "score", F.col("score") + F.coalesce("more", F.lit(0.0))
        )
    names = ("doc_id", "learn", "n_tokens", "n_known")
    return docs.select(*names, F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
