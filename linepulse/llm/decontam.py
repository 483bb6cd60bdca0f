"""Benchmark decontamination: a prefix-filtered join of documents with item windows.

Every run of `window` item words (the whole item, if it has fewer words) is a window. All its
words must occur, so one token is the necessary prefix of a window: its rarest word, by counts
over all documents. A document's occurrences of prefix words are the only candidates; a candidate
must leave room before and after it (positional and length bounds), and is verified by comparing
the words of the whole window.

The items are joined in blocks of about `block_bytes` of text, so what is broadcast has that bound;
further blocks are further passes over the documents, and nothing of them is shuffled. A long item
is first split into parts of about a twentieth of that (`2 * window` words at least) that share
window - 1 words, so no window is lost or added.

Null texts have no words. Repeated item rows count once by item_id; a null item_id is the item
"null". Repeated documents give repeated rows; an empty table on either side gives no hits. Texts of any
length are searched whole. Of words equally rare in a window one is its prefix, which changes no hit. Other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import map_batches, materialize, parts_for, text_or_empty

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case."""
    return text.encode().translate(_LETTERS).split()


def windows_of(text: str, window: int) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if not words:
        return set()
    return {tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


def parts_of(text: str, window: int, part_bytes: int) -> Iterator[str]:
    """The text, or its words in parts of about `part_bytes` that have its windows between them."""
    if len(text.encode()) <= part_bytes:
        yield text
        return
    part, size, new = [], 0, 0
    for word in words_of(text):
        if new and size + len(word) > part_bytes and len(part) >= 2 * window:
            yield b" ".join(part).decode()
            part = part[len(part) - window + 1 :]
            size, new = sum(len(w) + 1 for w in part), 0
        part.append(word)
        size, new = size + len(word) + 1, new + 1
    if new:
        yield b" ".join(part).decode()


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often each word of a bounded vocabulary occurs in all documents."""
    def work(batches):
        wanted, counts = vocabulary, Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(filter(wanted.__contains__, words_of(text)))
        yield {"word": list(counts), "n": list(counts.values())}

    found = map_batches(docs.select("text"), "word binary, n bigint", work)
    rows = found.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r[0]): r[1] for r in rows}


def prefix_index(items: list[tuple[str, str]], window: int, counts: dict[bytes, int]) -> dict:
    """{prefix word: {(its place in the window, window length): {window: item ids}}}"""
    index: dict = {}
    for item, text in items:
        for words in windows_of(text, window):
            place = min(range(len(words)), key=lambda i: (counts.get(words[i], 0), words[i], i))
            at = index.setdefault(words[place], {}).setdefault((place, len(words)), {})
            at.setdefault(b" ".join(words), set()).add(item)
    return index


def find(text: str, index: dict) -> tuple[int, set[int], set[str]]:
    """The number of words, the places of hit words and the items found."""
    words = words_of(text)
    n, hits, items = len(words), set(), set()
    for place in [i for i, w in enumerate(words) if w in index]:
        for (before, length), windows in index[words[place]].items():
            start = place - before
            if start >= 0 and start + length <= n:
                found = windows.get(b" ".join(words[start : start + length]))
                if found:
                    hits.update(range(start, start + length))
                    items |= found
    return n, hits, items


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 2_000_000
) -> DataFrame:
    """doc_id, n_words, hits (places of the words inside any window) and items (sorted ids)."""
    docs = docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text"))
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        text_or_empty().alias("text"),
    ).distinct()

    part_bytes = block_bytes // 20

    def split(batches):
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"], strict=True):
                for part in parts_of(text, window, part_bytes):
                    yield {"item": [item], "text": [part]}

    long = F.octet_length("text") > part_bytes
    items = materialize(
        items.where(~long).union(map_batches(items.where(long), "item string, text string", split)),
        "items",
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = parts_for(size, block_bytes)
    key = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    found = docs.withColumns(
        {
            "n_words": F.lit(0).cast("bigint"),
            "hits": F.array().cast("array<bigint>"),
            "items": F.array().cast("array<string>"),
        }
    )
    for block in range(blocks):
        rows = [(r[0], r[1]) for r in items.where(key == block).collect()]
        vocabulary = {w for _, text in rows for w in words_of(text)}
        index = prefix_index(rows, window, word_counts(docs, vocabulary) if rows else {})
        last = block == blocks - 1

        def work(batches, index=index, last=last):
            for batch in batches:
                out = {k: [] for k in ("doc_id", "text", "n_words", "hits", "items")}
                for doc, text, hits, items in zip(
                    *(batch[k] for k in ("doc_id", "text", "hits", "items")), strict=True
                ):
                    n, hit, item = find(text, index)
                    out["doc_id"].append(doc)
                    out["text"].append(None if last else text)
                    out["n_words"].append(n)
                    out["hits"].append(sorted(hit.union(hits)))
                    out["items"].append(sorted(item.union(items)))
                yield out

        found = map_batches(
            found,
            "doc_id bigint, text string, n_words bigint, hits array<bigint>, items array<string>",
            work,
        )
        if not last:
            found = materialize(found, "blocks")
    return found.drop("text")
