"""Main text of web pages: the maximum-scoring run of tokens.

A page is a sequence of tags and words. Words score by where they stand (their nearest block, or
the kind of boilerplate around them), tags score negative by their name. What stands in marked
boilerplate is left out anyway, so it hardly keeps apart what is around it. The weights are log odds
of being inside the article, counted over all pages that mark theirs with <article> or <main>.
A linear scan finds the contiguous run of the greatest sum; boilerplate nested in it is left out.
What holds the page's longest <article> (else <main>) is no boilerplate, whatever its name or class,
nor is what only its class, id or role marks if it holds most of the words of that element (else of
the page). A quote that doesn't close in its tag doesn't keep the tag from ending.

Null html is an empty page with an empty text. Very long pages are scanned whole, in time that
grows in line with their length. Of runs with equal sums the one that ends first is taken. Repeated rows give
repeated rows; an empty table gives none. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import map_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++"
    r"|=\s*+(?:\"[^\">]*+\"|'[^'>]*+'|\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>]))|=)*+)>?",
    re.S,
)
#: Elements by their part in a page.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "title", "textarea", "select"}
OUT = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "head"} | RAW
BLOCK = set(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption "
    "figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
) | OUT
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a b i em strong span small sub sup u s code mark q cite abbr time font label".split())
#: Words in class, id or role that mark an element as no part of the article.
MARKS = set(
    "ad ads advert advertisement sponsor sponsored promo banner comment comments reply sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent notice popup modal "
    "footer header masthead share social related recommended newsletter subscribe signup form "
    "widget toolbar pagination alert complementary contentinfo search".split()
)
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")


def _mark(attributes: str) -> str | None:
    """The boilerplate word that an element's class, id or role names."""
    for found in _ATTR.finditer(attributes):
        for part in _PART.findall((found[1] or found[2] or found[3] or "").lower()):
            if part in MARKS:
                return part
    return None


def tokens(page: str) -> list[tuple]:
    """(kind, name, text, inside, out): kind "tag" or "text"; name the feature that is weighed;
    inside: below <article> or <main>; out: below boilerplate.
    """
    elements: list[list] = []
    found = list(_scan(page, frozenset(), elements))
    kept = _kept(elements)
    return list(_scan(page, kept, [])) if kept else found


def _kept(elements: list[list]) -> frozenset[int]:
    """Places of the elements that are no boilerplate, though their name or marks say so.

    elements: name, boilerplate, first and last place, words before and up to the end; the first
    one is the page.
    """
    named = next(filter(None, ([e for e in elements if e[0] == n] for n in ("article", "main"))), [])
    first = max(named, key=lambda e: e[5] - e[4]) if named else None
    _, _, _, _, before, until = first or elements[0]
    kept = set()
    for _, out, start, end, w, upto in elements:
        holds = first is not None and start < first[2] < end
        most = 2 * (min(upto, until) - max(w, before)) > until - before
        if out and (holds or out[0] == "." and most):
            kept.add(start)
    return frozenset(kept)


def _scan(page: str, kept: frozenset[int], elements: list[list]):
    """The tokens; adds the elements that `_kept` looks at."""
    stack: list[tuple[str, str | None, list | None]] = []
    held, at, size = Counter(), 0, len(page)
    words = 0
    whole = ["", None, -1, size, 0, 0]
    elements.append(whole)

    def push(name: str, out: str | None, start: int) -> None:
        own = [name, out, start, size, words, None] if out or name in ("article", "main") else None
        if own:
            elements.append(own)
        stack.append((name, out, own))
        held[name] += 1
        if out:
            held["out!"] += 1

    def pop() -> str:
        name, out, own = stack.pop()
        if own:
            own[3], own[5] = found.start(), words
        held[name] -= 1
        if out:
            held["out!"] -= 1
        return name

    def place() -> tuple[str, bool, bool]:
        inside = bool(held["article"] or held["main"])
        if held["out!"]:
            return next(o for _, o, _ in reversed(stack) if o), inside, True
        return next((n for n, _, _ in reversed(stack) if n in BLOCK), "none"), inside, False

    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            found_at, after = size, size
        else:
            found_at, after = found.span()
        if found_at > at:
            words += len(page[at:found_at].split())
            yield "text", *_words(place(), page[at:found_at])
        if not found:
            break
        start, at = found_at, after
        name = (found[2] or "").lower()
        if not name:
            continue
        closing, attributes = found[1], found[3] or ""
        if closing:
            _, inside, out = place()
            if held[name] > 0:
                while pop() != name:
                    pass
            yield "tag", f"/{_known(name)}", name, inside, out
            continue
        if name in BLOCK and held["p"] > 0 and name not in ("body", "html"):
            while stack and (stack[-1][0] == "p" or stack[-1][0] in INLINE):
                if pop() == "p":
                    break
        if name == "li" and stack and stack[-1][0] == "li":
            pop()
        out = f"<{name}>" if name in OUT else None
        if not out and name not in ("html", "body", "article", "main"):
            mark = _mark(attributes)
            out = f".{mark}" if mark else None
        if start in kept:
            out = None
        _, inside, under = place()
        yield "tag", _known(name), name, inside, under or bool(out)
        if name in RAW and not (name == "svg" and attributes.endswith("/")):
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            if end or name != "svg":  # an svg without an end ends before what is no part of it
                at = end.end() if end else size
        elif name not in VOID and not attributes.endswith("/"):
            push(name, out, start)
    for e in [whole, *(own for _, _, own in stack if own)]:
        e[5] = words


def _words(where, text):
    name, inside, out = where
    return f"word {name}", text, inside, out


def _known(name: str) -> str:
    return name if name in BLOCK or name in VOID or name in INLINE else "other"


def weigh(pages: DataFrame) -> dict[str, float]:
    """Log odds of words and tags inside the article, over all pages that mark one.

    The names are those of the lists above, so there are a few hundred rows at most.
    """

    def work(batches):
        counts = Counter()
        for batch in batches:
            for page in batch["html"]:
                found = list(tokens(page or ""))
                if any(t[0] == "tag" and t[1] in ("article", "main") for t in found):
                    for kind, name, text, inside, out in found:
                        n = len(text.split()) if kind == "text" else 1
                        if n:
                            counts[name, inside and not out] += n
        yield {
            "name": [k[0] for k in counts],
            "inside": [k[1] for k in counts],
            "n": list(counts.values()),
        }

    rows = (
        map_batches(pages.select("html"), "name string, inside boolean, n bigint", work)
        .groupBy("name")
        .agg(
            F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"),
            F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("o"),
        )
        .collect()
    )
    inside, outside = sum(r["i"] for r in rows) + 1, sum(r["o"] for r in rows) + 1
    out = {}
    for r in rows:
        odds = math.log((r["i"] + 0.5) / inside * outside / (r["o"] + 0.5))
        out[r["name"]] = odds if r["name"].startswith("word ") else min(odds, TAG)
    return out


#: A tag scores at most this, and just this below boilerplate, whose words score nothing; a word
#: of a kind never seen scores this.
TAG, WORD = -0.05, 1.0


def extract(page: str, weights: dict[str, float]) -> str:
    """The text of the best run: blocks with single spaces, joined by two line ends."""
    found = list(tokens(page))
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for k, (kind, name, text, _, out) in enumerate(found):
        if kind == "tag":
            score = TAG if out else weights.get(name, TAG)
        else:
            score = 0.0 if out else weights.get(name, WORD) * len(text.split())
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, best_at = total, (start, k + 1)
    blocks, now = [], []
    for kind, _, text, _, out in found[slice(*best_at)]:
        if kind == "text":
            if not out:
                now.append(text)
        elif text in BLOCK:
            blocks.append("".join(now))
            now = []
        elif text == "br":
            now.append(" ")
    blocks.append("".join(now))
    clean = (" ".join(entities.unescape(b).split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page."""
    weights = weigh(pages)

    def work(batches):
        for batch in batches:
            yield {
                "page_id": batch["page_id"],
                "url": batch["url"],
                "text": [extract(p or "", weights) for p in batch["html"]],
            }

    return map_batches(
        pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html"),
        "page_id bigint, url string, text string",
        work,
    )
