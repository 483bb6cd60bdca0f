"""Chat formatting: turns of typed content parts become one marked string for each conversation.

A part is text, an image, an audio clip or a document. A visitor flattens the parts of a turn, in
their order: text is escaped, every other part leaves a placeholder, a reference in the list of
attachments (the n-th placeholder belongs to the n-th attachment) and the number of tokens that
the placeholder stands for. A text after other parts has a mark before it.

    <|im_start|>ROLE\\nTEXT<|image|><|part|>TEXT<|im_end|>\\n

Texts cannot contain control strings: `<|` is written `<\\|`, and what was `<\\|` gets one more
backslash, so unescaping gives every text back. Roles are URL-encoded, so they end at the line end.

The loss mask is run-length encoded over the string, one run (skip, take) for each control string:
`skip` characters without loss, then `take` with it. Runs need no running sums, so a turn is
formatted where it lies, and only `conversations` brings the turns of one conversation together,
as its string is one value.

Null texts and roles are empty; null parts and empty text parts leave no trace; null content is a
turn without text; parts of any other kind, null included, leave `<|other|>`. A null conv_id is a
conversation of its own. Turns go by turn, nulls first; ties by role, then by text, so repeated rows
stand side by side. Texts are never cut, however long. An empty table gives no rows. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings of the template.
START, END, BETWEEN = "<|im_start|>", "<|im_end|>\n", "<|part|>"
#: A content part; columns that a kind doesn't use are null.
PART = (
    "struct<kind: string, text: string, ref: string, width: bigint, height: bigint, "
    "seconds: double, pages: bigint>"
)
_FLAT = "struct<mark: string, body: string, kind: string, ref: string, tokens: bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def text_part(text: Column) -> Column:
    """Content of one text part."""
    return F.array(
        F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text")).cast(
            "struct<kind: string, text: string>"
        )
    )


def json_parts(content: Column) -> Column:
    """Content from JSON: an array of objects with the fields of `PART`; any other text is one part."""
    parts = F.from_json(content, f"array<{PART}>")
    as_text = F.array(
        F.from_json(F.to_json(F.struct(F.lit("text").alias("kind"), content.alias("text"))), PART)
    )
    return F.when(F.ltrim(content).startswith("[") & parts.isNotNull(), parts).otherwise(as_text)


@dataclass(frozen=True)
class Visitor:
    """What each kind of part becomes. The numbers say how many tokens a placeholder stands for.

    A subclass with a method of another kind's name, listed in `kinds`, handles that kind.
    """

    patch: int = 28
    audio_rate: float = 25.0
    page_tokens: int = 512
    kinds: tuple[str, ...] = ("text", "image", "audio", "document")

    def text(self, part: Column) -> Column:
        return _flat(BETWEEN, escape(F.coalesce(part["text"], F.lit(""))), "text")

    def image(self, part: Column) -> Column:
        tiles = F.ceil(part["width"] / self.patch) * F.ceil(part["height"] / self.patch)
        return _placeholder("image", part, tiles)

    def audio(self, part: Column) -> Column:
        return _placeholder("audio", part, F.ceil(part["seconds"] * self.audio_rate))

    def document(self, part: Column) -> Column:
        return _placeholder("document", part, part["pages"] * self.page_tokens)

    def other(self, part: Column) -> Column:
        return _placeholder("other", part, F.lit(0))

    def visit(self, part: Column, fields: list[str]) -> Column:
        """The flattened form of any part; `fields` are those that the content has."""
        part = {name: part[name] if name in fields else F.lit(None) for name in _FIELDS}
        out = self.other(part)
        for kind in reversed(self.kinds):
            out = F.when(part["kind"] == kind, getattr(self, kind)(part)).otherwise(out)
        return out


_FIELDS = ("kind", "text", "ref", "width", "height", "seconds", "pages")


def _flat(mark: str, body: Column, kind: str, ref: Column | None = None, tokens: Column | None = None):
    return F.struct(
        F.lit(mark).alias("mark"),
        body.alias("body"),
        F.lit(kind).alias("kind"),
        (F.lit(None) if ref is None else ref).cast("string").alias("ref"),
        (F.lit(0) if tokens is None else F.coalesce(tokens, F.lit(0))).cast("bigint").alias("tokens"),
    ).cast(_FLAT)


def _placeholder(kind: str, part: dict, tokens: Column) -> Column:
    return _flat(f"<|{kind}|>", F.lit(""), kind, part["ref"], tokens)


def format_turns(
    turns: DataFrame, content: Column, learn: Column | None = None, visitor: Visitor | None = None
) -> DataFrame:
    """conv_id, turn, role, formatted, mask, attachments of each row; no shuffle.

    `content` is an array of parts (a prefix of the fields of `PART` will do); `learn` says which
    turns have a loss, those of the assistant if not given.
    """
    visitor = visitor or Visitor()
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.select(
        F.col("conv_id").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.coalesce(role == "assistant" if learn is None else learn, F.lit(False)).alias("learn"),
        content.alias("content"),
    )
    fields = rows.schema["content"].dataType.elementType.fieldNames()
    parts = F.filter(
        F.coalesce("content", F.array().cast(rows.schema["content"].dataType)),
        lambda p: p.isNotNull() & ~F.coalesce((p["kind"] == "text") & (F.coalesce(p["text"], F.lit("")) == ""), F.lit(False)),
    )
    rows = rows.withColumn("flat", F.transform(parts, lambda p: visitor.visit(p, fields))).drop("content")
    first_text = F.coalesce(F.get("flat", F.lit(0))["kind"] == "text", F.lit(False))
    head = F.struct(
        F.concat(F.lit(START), F.url_encode("role"), F.lit("\n")).alias("mark"),
        F.when(first_text, F.get("flat", F.lit(0))["body"]).otherwise("").alias("body"),
        F.lit("turn").alias("kind"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(0).cast("bigint").alias("tokens"),
    ).cast(_FLAT)
    rest = F.when(first_text, F.slice("flat", 2, F.greatest(F.size("flat") - 1, F.lit(0)))).otherwise(F.col("flat"))
    pieces = F.concat(F.array(head), rest, F.array(_flat(END, F.lit(""), "turn")))
    rows = rows.withColumn("pieces", pieces)

    def run(piece: Column) -> Column:
        mark, body = F.length(piece["mark"]), F.length(piece["body"])
        return F.struct(
            F.when(F.col("learn"), mark).otherwise(mark + body).cast("bigint").alias("skip"),
            F.when(F.col("learn"), body).otherwise(0).cast("bigint").alias("take"),
        )

    return rows.select(
        "conv_id",
        "turn",
        "role",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["body"])), "").alias("formatted"),
        F.transform("pieces", run).alias("mask"),
        F.transform(
            F.filter("flat", lambda p: p["kind"] != "text"),
            lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")),
        ).alias("attachments"),
    )


def conversations(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, mask, attachments and n_expanded (the tokens that placeholders stand for)."""
    rows = F.sort_array(
        F.collect_list(F.struct("turn", "role", "formatted", "mask", "attachments"))
    )
    return (
        formatted.groupBy("conv_id")
        .agg(rows.alias("rows"))
        .select(
            "conv_id",
            F.array_join(F.transform("rows", lambda r: r["formatted"]), "").alias("formatted"),
            F.flatten(F.transform("rows", lambda r: r["mask"])).alias("mask"),
            F.flatten(F.transform("rows", lambda r: r["attachments"])).alias("attachments"),
        )
        .withColumn(
            "n_expanded",
            F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]),
        )
    )


def _body(piece: Column) -> Column:
    """The unescaped text after the control string, and after the role."""
    after = F.when(piece.startswith(START), F.instr(piece, "\n")).otherwise(F.instr(piece, ">"))
    return unescape(F.substr(piece, after + 1))


def read_back(done: DataFrame, *columns: str) -> DataFrame:
    """`columns` and what the formatted string alone gives back: turns (role, newline, text and newline
    for each), n_turns, and with the mask loss (the texts under it, joined).
    """

    def plain(piece: Column) -> Column:
        role = F.url_decode(F.substring_index(F.substr(piece, F.lit(len(START) + 1)), "\n", 1))
        return (
            F.when(piece.startswith(START), F.concat(role, F.lit("\n"), _body(piece)))
            .when(piece == END, "\n")
            .otherwise(_body(piece))
        )

    def learnt(piece: Column, run: Column) -> Column:
        taken = F.substr(piece, run["skip"].cast("int") + 1, run["take"].cast("int"))
        return F.when(run["take"] > 0, unescape(taken)).otherwise("")

    split = done.withColumn("_pieces", F.split("formatted", r"(?=<\|)"))
    return split.select(
        *columns,
        F.size(F.filter("_pieces", lambda p: p.startswith(START))).cast("bigint").alias("n_turns"),
        F.array_join(F.transform("_pieces", plain), "").alias("turns"),
        F.array_join(F.zip_with("_pieces", "mask", learnt), "").alias("loss"),
    )
