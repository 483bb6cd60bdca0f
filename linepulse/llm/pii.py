"""Personal data by weak supervision: labelers vote on candidate spans, their reliabilities are
estimated by expectation-maximisation, and a span classifier trained on the outcome decides.

Candidates are the matches of strict patterns (email, ip, card, phone) and of looser ones (masked
emails, local phone numbers, secrets after a key word, names after a title), of the gazetteer (first
names and what follows them) and of contexts (names and numbers after "name:", "phone" and the like).
Four labelers vote for, against or not at all: the pattern with its checks, a gazetteer of words in the span, the
context of words before it, and the characters around it. Equal votes and features are counted,
so what goes to the driver is a table of their combinations (at most a few thousand), whatever
the input; the classifier is a logistic regression on the features alone. Strict matches that
pass their checks always stay, those that fail serve as examples and are dropped; looser ones are
added where the classifier says so, also beside a strict match that they overlap, unless one of
their own kind holds them whole.

All of it is built-in functions. A span is kind, start and end in code points, end exclusive.
Null text is empty and has no spans. Texts, names and addresses of any length are taken whole. Equal votes are
counted together and repeated rows each, so rows are judged alike; spans at one place go by kind. An empty table
gives no rows. Other columns are kept, whatever their names, but a column `_spans` is refused.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import materialize, owned, text_or_empty

#: Kinds in the order in which spans at one place are listed.
KINDS = ["email", "ip", "card", "phone", "secret", "person"]
#: Patterns. They find what plain greedy ones find from left to right, but don't
#: try again inside a run that has failed.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_KEY = r"(?i)(?:password|passwd|pwd|token|secret|api[_\x20-]?key)[\"']?[\x20\t]*+[=:]"
_TITLE = r"(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sr|Sra)\.? "
#: First names that are no common word.
FIRST_NAMES = (
    "Adam Adrian Albert Alejandro Alexander Alice Alicia Amélie Ana Andrea Andreas Andrew Angela Anna Anne Anneliese Anthony "
    "Antoine Antonio Arthur Barbara Beatriz Benjamin Bernard Birgit Björn Brian Camille Carlos Carmen Caroline Catherine "
    "Cécile Charles Charlotte Christian Christina Christine Christopher Claire Claudia Cristina Daniel Daniela David Deborah "
    "Diego Dieter Dominique Donald Dorothea Edward Eduardo Elena Elisabeth Elizabeth Emily Emma Enrique Eric Erika Ernst "
    "Étienne Eva Felix Fernando Francisco François Françoise Franz Friedrich Gabriel Geneviève George Gerhard Gisela Gregory "
    "Guillaume Gustav Hannah Hans Heinrich Helen Helena Hélène Helga Helmut Henri Henry Hermann Horst Hugo Ignacio Ingrid "
    "Isabel Isabelle Jacques James Jane Javier Jean Jennifer Jérôme Jessica Joachim Johann Johannes John Jonathan Jorge José "
    "Joseph Juan Juana Julia Julie Julien Jürgen Karen Karin Karl Katharina Kathrin Kevin Klaus Konrad Kurt Laura Laurent "
    "Léa Leonie Linda Lisa Louis Louise Lucas Lucía Luis Lukas Manfred Manon Manuel Margaret Margarita María Maria Marie "
    "Markus Marta Martin Mary Mathieu Matthew Matthias Michael Michel Michelle Miguel Monika Mónica Nathalie Nicholas "
    "Nicolas Nicole Olivier Oscar Pablo Patricia Patrick Paul Pedro Peter Philippe Pierre Rafael Raúl Rebecca Renate Ricardo "
    "Richard Robert Roberto Roland"
).split()
_FIRST = rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(FIRST_NAMES)}|Jose)(?![\p{{L}}\p{{M}}\p{{N}}_])"
_NAME = r"\p{Lu}(?:[\p{L}\p{M}]|['’-](?=\p{L}))++"
_NAMED = r"(?<=(?<![\p{L}\p{N}])(?i:name|contact|user|login)\x20?[=:]\x20?[\"']?)"
_CALLED = (
    r"(?<=(?<![\p{L}\p{N}])(?i:phone|tel|call|fax|mobile|contact)[^\p{L}\p{N}+(]{0,4}"
    r"(?i:is|number|nr)?[^\p{L}\p{N}+(]{0,3})"
)
LOOSE = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++ ?[\[(] ?dot ?[\])] ?[A-Za-z]{2,}+",
        r"at ?[\])]",
    ),
    "phone": (
        r"(?<![0-9A-Za-z+.(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])"
        rf"|(?=[0-9(]){_CALLED}\(?[0-9](?:[\x20()./-]{{0,2}}+[0-9]){{5,14}}+(?![0-9A-Za-z-])",
        r"[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"
        r"|(?i:phone|tel|call|fax|mobile|contact)[^\p{L}\p{N}+(]{0,4}(?i:is|number|nr)?[^\p{L}\p{N}+]{0,4}[0-9]",
    ),
    "secret": (
        _KEY
        + r"[\x20\t]*+(?:\"[^\"\n]{8,}+\"|'[^'\n]{8,}+'"
        r"|[\"']?(?:[^\s\"'<>,;.!?:)\]}]|[.!?:)\]}](?=[^\s\"'<>,;])){8,}+[\"']?)",
        _KEY,
    ),
    "person": (
        rf"{_TITLE}{_NAME}(?: {_NAME})?|{_FIRST}(?: {_NAME})?"
        rf"|(?=\p{{Lu}}){_NAMED}{_NAME}(?: {_NAME})?",
        rf"{_TITLE}\p{{Lu}}|{_FIRST}|(?i:name|contact|user|login)\x20?[=:]\x20?[\"']?\p{{Lu}}",
    ),
}
#: Words of the gazetteer and of contexts.
GAZETTEER = (
    r"(?i:mail|example|gmail|yahoo|proton|outlook|password|passwd|token|secret)|" + _FIRST
)
CONTEXT = (
    r"(?i)(?:mail|phone|tel|call|fax|mobile|contact|card|visa|account|konto|carte|tarjeta|login"
    r"|user|name|address|server|host|ip)[^A-Za-z]{0,4}(?:is|:|=|number|nr)?[^A-Za-z]{0,3}$"
)


def let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, pattern: str) -> Column:
    """All matches as an array of (start, end, text), in code points.

    The text between matches and the matches themselves give the places by their lengths.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"),
    )

    def step(state, pair):
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("text"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    pairs = F.zip_with(
        F.slice(gaps, 1, F.size(found)), found, lambda g, f: F.struct(g.alias("gap"), f.alias("found"))
    )
    return F.aggregate(pairs, empty, step, lambda s: s["out"])


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    places = F.split(F.reverse(digits), "")
    each = F.transform(
        F.filter(places, lambda c: c != ""),
        lambda c, i: let(
            c.cast("int") * (1 + i % 2), lambda v: F.when(v > 9, v - 9).otherwise(v)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda s, v: s + v) % 10 == 0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: kind: pattern, condition on the text to look at all, and check of a match.
STRICT = {
    "email": (EMAIL, lambda t: t.contains("@"), lambda m: F.lit(True)),
    "ip": (
        IP,
        lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
        lambda m: m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"),
    ),
    "card": (
        CARD,
        lambda t: t.rlike(CARD),
        lambda m: let(_digits(m), lambda d: (F.length(d) <= 19) & luhn(d)),
    ),
    "phone": (
        PHONE,
        lambda t: t.contains("+"),
        lambda m: F.length(_digits(m)).between(9, 15),
    ),
}

_SPAN = (
    "array<struct<start:int,rank:int,end:int,text:string,strict:boolean,passed:boolean>>"
)


def _spans(text: Column, kind: str, pattern: str, when: Column, check) -> Column:
    """Spans of one kind; check is None for the looser patterns."""
    rank = KINDS.index(kind)
    found = F.transform(
        matches(text, pattern),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(rank).alias("rank"),
            m["end"].alias("end"),
            m["text"].alias("text"),
            F.lit(check is not None).alias("strict"),
            (check(m["text"]) if check else F.lit(None).cast("boolean")).alias("passed"),
        ),
    )
    return F.when(when, found).otherwise(F.array()).cast(_SPAN)


LABELERS = ["pattern", "gazetteer", "context", "around"]


def _with_votes(text: Column, span: Column) -> Column:
    """The span with its labelers' votes (1 for, 0 against, -1 none) and features."""
    before = F.substring(text, F.greatest(span["start"] - 29, F.lit(1)), F.least(span["start"], F.lit(30)))
    after = F.substring(text, span["end"] + 1, F.lit(1))
    context = before.rlike(CONTEXT)
    tight = before.rlike("[0-9A-Za-z_.-]$") | after.rlike("^[0-9A-Za-z_-]")
    known = span["text"].rlike(GAZETTEER)
    digits = F.length(_digits(span["text"]))

    def vote(yes, no=F.lit(-1)):
        return F.when(yes, 1).otherwise(no).cast("int")

    return F.struct(
        span["start"].alias("start"),
        span["rank"].alias("rank"),
        span["end"].alias("end"),
        (span["strict"] & span["passed"]).alias("base"),
        F.array(
            F.coalesce(span["passed"].cast("int"), F.lit(-1)),
            vote(known),
            vote(context),
            vote(~tight, F.lit(0)),
        ).alias("votes"),
        F.array(
            span["rank"],
            F.coalesce(span["passed"].cast("int"), F.lit(2)),
            context.cast("int"),
            known.cast("int"),
            tight.cast("int"),
            F.least((digits / 6).cast("int"), F.lit(3)),
            F.least(((span["end"] - span["start"]) / 12).cast("int"), F.lit(3)),
        ).alias("features"),
    )


#: Values of each feature: kind, check, context, gazetteer, around, digits, length.
FEATURES = [len(KINDS), 3, 2, 2, 2, 4, 4]


def candidates(docs: DataFrame, own: Column) -> DataFrame:
    """`_own`, a struct of the caller's columns, and `_spans`: the base spans, strict matches that none of these
    overlaps and looser ones that none of their kind holds.
    """
    docs, text = docs.select(own.alias("_own"), text_or_empty().alias("_text")), F.col("_text")
    groups = [_spans(text, k, p, w(text), c) for k, (p, w, c) in STRICT.items()]
    groups += [_spans(text, k, p, text.rlike(w), None) for k, (p, w) in LOOSE.items()]
    found = docs.withColumn("_all", F.concat(*groups))

    def fits(span: Column) -> Column:
        return span["strict"] & span["passed"] | ~F.exists(
            "_base",
            lambda b: F.when(
                span["strict"], (b["start"] < span["end"]) & (span["start"] < b["end"])
            ).otherwise(
                (b["rank"] == span["rank"])
                & (b["start"] <= span["start"])
                & (span["end"] <= b["end"])
            ),
        )

    found = found.withColumn(
        "_base", F.filter("_all", lambda s: s["strict"] & F.coalesce(s["passed"], F.lit(False)))
    )
    spans = F.transform(F.filter("_all", fits), lambda s: _with_votes(text, s))
    none = F.size("_all") == 0
    return found.select("_own", F.when(none, F.array()).otherwise(spans).alias("_spans"))


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Expectation-maximisation over vote patterns: how probable each is personal data.

    A labeler has probabilities of its three votes for either truth, smoothed by one count.
    """
    truth = np.clip(0.5 + 0.35 * np.sign((votes == 1).sum(1) - 2 * (votes == 0).sum(1)), 0.1, 0.9)
    for _ in range(rounds):
        share = np.clip((truth * counts).sum() / max(1, counts.sum()), 0.01, 0.99)
        yes, no = np.full(len(votes), np.log(share)), np.full(len(votes), np.log(1 - share))
        for k in range(votes.shape[1]):
            for total, weight in ((yes, truth * counts), (no, (1 - truth) * counts)):
                sums = np.array([weight[votes[:, k] == v].sum() for v in (-1, 0, 1)]) + 1
                total += np.log(sums / sums.sum())[votes[:, k] + 1]
        truth = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
    return truth


def classifier(features: np.ndarray, truth: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Logistic regression on the one-hot features; weights by feature and value."""
    starts = np.cumsum([0, *FEATURES])
    x = np.zeros((len(features), starts[-1] + 1))
    x[:, -1] = 1
    for k in range(len(FEATURES)):
        x[np.arange(len(features)), starts[k] + features[:, k]] = 1
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (p - truth)) + 0.5 * w
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(curve, gradient), -4, 4)
    return [w[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)] + [w[-1:]]


def train(found: DataFrame) -> list[np.ndarray]:
    """Weights of the span classifier from all candidates of a table with `_spans`."""
    rows = (
        found.where(F.size("_spans") > 0)
        .select(F.explode("_spans").alias("s"))
        .groupBy("s.votes", "s.features")
        .count()
        .collect()
    )
    if not rows:
        return [np.zeros(n) for n in FEATURES] + [np.array([-1.0])]
    votes, features = (np.array([r[k] for r in rows]) for k in (0, 1))
    counts = np.array([r[2] for r in rows], float)
    return classifier(features, reliabilities(votes, counts), counts)


def spans(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """docs (or those columns) with `_spans`: the base spans and those added, by start and kind.

    The candidates are written once, so the classifier is trained on what it then judges.
    """
    names, own = owned(docs, columns, ("_spans",))
    found = materialize(candidates(docs, own), "candidates")
    weights = train(found)

    def wanted(s: Column) -> Column:
        score = F.lit(float(weights[-1][0]))
        for k, w in enumerate(weights[:-1]):
            score = score + F.element_at(
                F.array(*[F.lit(float(x)) for x in w]), s["features"][k] + 1
            )
        return s["base"] | ((s["votes"][0] != 0) & (score > 0))

    kept = F.array_sort(
        F.transform(
            F.filter("_spans", wanted),
            lambda s: F.struct(
                s["start"].alias("start"),
                s["rank"].alias("rank"),
                s["end"].alias("end"),
                s["base"].alias("base"),
            ),
        )
    )
    return found.select(*[F.col("_own")[n].alias(n) for n in names], kept.alias("_spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"]),
        ),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of spans that overlap, the
    first stands for all.
    """
    kinds = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state, s):
        between = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        end = F.greatest(s["end"], state["at"])
        return F.when(
            s["start"] >= state["at"],
            F.struct(
                end.alias("at"),
                F.concat(state["out"], F.array(between, F.element_at(kinds, s["rank"] + 1))).alias("out"),
            ),
        ).otherwise(F.struct(end.alias("at"), state["out"].alias("out")))

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(
            spans,
            empty,
            step,
            lambda s: F.concat(
                F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))
            ),
        )
    )
