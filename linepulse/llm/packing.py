"""Packing of documents into token sequences by cutting-stock column generation.

A document is cut into pieces of the full sequence length and one shorter rest. The histogram of
piece lengths, in classes of `grain` tokens, goes to the driver: it has at most
``capacity / grain`` rows, whatever the input. There a linear program over patterns (how many
pieces of each class share a sequence) is solved by column generation, where a knapsack dynamic
program prices new patterns. Rounded down, the patterns and a greedy filling of what is left give
every rank of every class its sequence; the ranks are dealt to the pieces by Spark.

Null text is an empty document, which is its end id alone. Texts of any length are cut whole into pieces. Repeated
rows are packed as often as they occur; pieces of equal length are ranked in any order, which changes no padding.
An empty table gives no pieces. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import os
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linepulse.llm.common import materialize, parts_for, ship, text_or_empty

#: Words whose ids a Python worker remembers at most; then it starts anew.
REMEMBERED = 250_000
#: Bytes of texts tokenized together, about.
AT_ONCE = 4_000_000
#: Pieces ranked together.
RANKED = 20_000

_tokenizers: dict = {}


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes are themselves, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


#: Texts that are not lower-cased before they are split: combining characters may compose with
#: letters of one case only, and special tokens are lower case.
_ODD = "[\u0300-\u036f\u02be]|<\\|"
_AFTER = r"([a-z])([.,;:!?#$%&*|=()-]+ )"


class _Words:
    """Ids of texts, by words between spaces, which the tokenizer's pieces never cross.

    If the tokenizer lower-cases and splits letters from marks (it is asked once), the letters of a
    word go straight to its model and the marks after them are remembered on their own; any word
    of another form is encoded whole.
    """

    MARKS = ".,;:!?#$%&*|=-()\""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.marks = Tokenizer.from_file(path), _Known(self), {}
        self.letters = _byte_letters()
        probe = ["Abc", "\u00c9t\u00e9", "Zq,", "a.,;", "\u00dfx#", "Word!!", "s$$$"]
        self.plain = True
        whole = [self._ids(w) for w in probe]
        self.plain = [self._new(w) for w in probe] == whole
        self.known = _Known(self)

    def _ids(self, word: str) -> bytes:
        return _bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _new(self, word: str) -> bytes:
        body = word.rstrip(self.MARKS)
        low = body.lower()
        if not (
            self.plain
            and low.isalpha()
            and (low.isascii() or "\u03a3" not in body and unicodedata.is_normalized("NFC", body))
            and low.islower()
        ):
            return self._ids(word)
        got = self.known.get(low)
        if got is None:
            mapped = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
            got = _bytes([t.id for t in self.tokenizer.model.tokenize(mapped)])
            if len(low) < len(word):
                self.known[low] = got
        marks = word[len(body) :]
        if not marks:
            return got
        if marks not in self.marks:
            if len(self.marks) > 10_000:
                self.marks = {}
            self.marks[marks] = self._ids(marks)
        return got + self.marks[marks]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's ids start (and the last one's end).

        Different words are looked up once for all texts; ids are then gathered by word.
        """
        if len(self.known) > REMEMBERED:
            self.known = _Known(self)
        texts = pc.replace_substring(texts, "\n", " ")
        if self.plain and not pc.any(pc.match_substring_regex(texts, _ODD)).as_py():
            # marks after ASCII letters are words of their own, so there are fewer different ones
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), _AFTER, r"\1 \2")
        split = pc.split_pattern(texts, " ")
        words = split.flatten().dictionary_encode()
        at = words.indices.to_numpy()
        found = list(map(self.known.__getitem__, words.dictionary.to_pylist()))
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(counts) - counts
        each = counts[at]
        ends = np.cumsum(each)
        place = np.repeat(starts[at] - (ends - each), each)
        place += np.arange(len(place))
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return np.frombuffer(b"".join(found), "<u4")[place], bounds


class _Known(dict):
    """Ids by word; a word that is missing is encoded."""

    def __init__(self, words: _Words):
        self.words = words
        self[""] = b""

    def __missing__(self, word: str) -> bytes:
        self[word] = got = self.words._new(word)
        return got


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1
) -> DataFrame:
    """Tokenizes whole texts, adds `end_id` and cuts: doc_id, start, length, doc_tokens and the
    ids as little-endian unsigned 32-bit numbers.

    `tokenizer` is a file of the `tokenizers` library whose pre-tokenizer splits at spaces.
    """
    end = _bytes([end_id])
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]

    def work(batches):
        if tokenizer not in _tokenizers:
            _tokenizers[tokenizer] = _Words(tokenizer)
        words = _tokenizers[tokenizer]
        for batch in batches:
            step = max(1, batch.num_rows * AT_ONCE // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids, bounds = words.encode(part.column("text"))
                out = []
                for doc, i, j in zip(
                    part.column("doc_id").to_pylist(), bounds[:-1], bounds[1:], strict=True
                ):
                    got = ids[i:j].tobytes() + end
                    total = len(got) // 4
                    for start in range(0, total, capacity):
                        cut = got[4 * start : 4 * (start + capacity)]
                        out.append((doc, start, len(cut) // 4, total, cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names,
                )
            pa.default_memory_pool().release_unused()

    ship(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")
    ).mapInArrow(work, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary")


def best_pattern(worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: unbounded knapsack, classes 1..n weigh their number."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    n = len(worth)
    for room in range(1, capacity + 1):
        most = min(n, room)
        found = best[room - most : room][::-1] + worth[:most]  # class k leaves room - k
        k = int(found.argmax())
        if found[k] > best[room - 1] + 1e-12:
            best[room], took[room] = found[k], k + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(n), capacity
    while room > 0:
        if took[room]:
            pattern[took[room] - 1] += 1
            room -= took[room]
        else:
            room -= 1
    return float(best[capacity]), pattern


def cutting_stock(demand: np.ndarray, capacity: int, most_columns: int = 20_000):
    """The linear program's patterns and how often each is used, found by column generation.

    demand[k - 1] pieces of class k are needed; a sequence holds classes up to `capacity` in sum.
    """
    used = np.flatnonzero(demand)
    n = len(demand)
    if not len(used):
        return []
    columns = np.zeros((n, len(used)))
    for j, k in enumerate(used):
        columns[k, j] = capacity // (k + 1)
    need = demand[used].astype(float)
    inverse = np.diag(1.0 / columns[used, np.arange(len(used))])
    amount = inverse @ need
    for _ in range(most_columns):
        worth = np.zeros(n)
        worth[used] = np.maximum(inverse.sum(axis=0), 0)
        value, pattern = best_pattern(worth, capacity)
        if value <= 1 + 1e-7:
            break
        step = inverse @ pattern[used]
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        inverse[out] /= step[out]
        amount[out] = ratio[out]
        others = np.arange(len(used)) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        amount[others] = np.maximum(0, amount[others] - step[others] * ratio[out])
        columns[:, out] = pattern
    return [(columns[:, j].astype(int), float(amount[j])) for j in range(len(used))]


def patterns_for(demand: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Whole numbers of patterns that meet the demand: (classes, how often)."""
    left = demand.astype(int).copy()
    out = []
    for pattern, amount in cutting_stock(demand, capacity):
        fits = [left[k] // pattern[k] for k in np.flatnonzero(pattern)]
        times = min([int(amount + 1e-6), *fits]) if fits else 0
        if times > 0:
            left -= times * pattern
            out.append((pattern, times))
    while left.any():  # what rounding left: the largest that fit, as often as they can
        room, pattern = capacity, np.zeros(len(left), int)
        for k in np.flatnonzero(left)[::-1]:
            pattern[k] = min(left[k], room // (k + 1))
            room -= pattern[k] * (k + 1)
        times = int(min(left[k] // pattern[k] for k in np.flatnonzero(pattern)))
        left -= times * pattern
        out.append((pattern, times))
    return [(np.repeat(np.arange(1, len(p) + 1), p).tolist(), t) for p, t in out]


def pack(cut: DataFrame, capacity: int = 2048, grain: int = 8) -> DataFrame:
    """Adds sequence_id and offset to pieces with doc_id, start and length (1 to `capacity`).

    The rows are written once to the shared folder, so the histogram and the ranks see the same.
    """
    cut = materialize(
        cut.withColumn("_class", F.ceil(F.col("length") / grain).cast("int")), "pieces"
    )
    spark = cut.sparkSession
    demand = np.zeros(capacity // grain, int)
    for row in cut.groupBy("_class").count().collect():
        demand[row[0] - 1] = row[1]
    runs, taken, sequence = [], [0] * (len(demand) + 1), 0
    for classes, times in patterns_for(demand, capacity // grain):
        for slot, k in enumerate(classes):
            runs.append((k, taken[k], taken[k] + times, sequence - taken[k], slot))
            taken[k] += times
        sequence += times
    plan = spark.createDataFrame(
        runs or [(0, 0, 0, 0, 0)],
        "_c int, _from bigint, _to bigint, _shift bigint, _slot int",
    )
    # ranks within a class, first in buckets of bounded size and then over the buckets
    buckets = parts_for(int(demand.sum()), RANKED)
    cut = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    before = (
        cut.groupBy("_class", "_bucket")
        .count()
        .select(
            F.col("_class").alias("_k"),
            F.col("_bucket").alias("_b"),
            (
                F.sum("count").over(Window.partitionBy("_class").orderBy("_bucket"))
                - F.col("count")
            ).alias("_before"),
        )
    )
    order = ["doc_id", "start", "length", *[c for c in cut.columns if c == "ids_crc32"]]
    ranked = (
        cut.withColumn(
            "_row", F.row_number().over(Window.partitionBy("_class", "_bucket").orderBy(*order))
        )
        .join(before, (F.col("_class") == F.col("_k")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_rank", F.col("_before") + F.col("_row") - 1)
    )
    placed = ranked.join(
        plan,
        (F.col("_class") == F.col("_c"))
        & (F.col("_rank") >= F.col("_from"))
        & (F.col("_rank") < F.col("_to")),
    ).withColumn("sequence_id", F.col("_rank") + F.col("_shift"))
    earlier = (
        Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.withColumn(
        "offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))
    ).drop("_class", "_bucket", "_row", "_k", "_b", "_before", "_rank", *plan.columns)


def sequences(packed: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """The padded sequences of packed pieces with their ids: sequence_id, n_tokens, ids (binary).

    A sequence whose length is a power of two stays as it is, any other is padded to `capacity`.
    """
    pad = F.lit(np.array([pad_id], "<u4").tobytes())
    joined = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("h")))).alias("parts"),
    )
    n = F.col("n_tokens")
    whole = F.bit_count(n) == 1
    padding = F.when(whole, 0).otherwise(capacity - n).cast("int")
    return joined.select(
        "sequence_id",
        "n_tokens",
        F.unhex(
            F.concat(
                F.array_join(F.transform("parts", lambda p: p["h"]), ""),
                F.repeat(F.hex(pad), padding),
            )
        ).alias("ids"),
    )
