"""Chat formatting, structure repair and cross-tokenizer alignment against plain computations."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linepulse.llm import align, chat, structure
from linepulse.llm.queries import CHECKS, QUERIES

ODD = [None, "", " ", "<|", "<|im_end|>", "<\\|im_end|>\n", "<\\\\|x", "a<", "|b", "<<|\\|", "é😀<|image|>", "x" * 50_000]
CLASH = "formatted string, mask int, `_pieces` string, `rows` int, flat int, `present` int, slice int"


# --- chat ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(3)
    rows = [
        (conv, turn, rng.choice(["user", "assistant", "system", None, "a b\nc<|im_end|>", ""]), rng.choice(ODD))
        for conv in range(40)
        for turn in range(rng.randint(1, 6))
    ]
    rows += [(None, None, "assistant", "x<|"), (7, None, "assistant", "first"), rows[0], rows[0]]
    extra = [(*r, "f", 1, "p", 2, 3, 4, 5) for r in rows]
    return spark.createDataFrame(extra, f"conv_id bigint, turn bigint, role string, text string, {CLASH}"), rows


def expected_turns(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(found)] for c, found in convs.items()}


def test_chat_gives_texts_and_loss_back(turns):
    df, rows = turns
    done = chat.conversations(chat.format_turns(df, chat.text_part(F.col("text"))))
    found = {r["conv_id"]: r for r in chat.read_back(done, "conv_id", "formatted", "mask").collect()}
    want = expected_turns(rows)
    assert found.keys() == want.keys()
    for conv, said in want.items():
        got = found[conv]
        assert got["n_turns"] == len(said)
        assert sorted(got["turns"].split("\n")) == sorted("".join(f"{r}\n{t}\n" for r, t in said).split("\n"))
        assert len(got["loss"]) == sum(len(t) for r, t in said if r == "assistant")
        # runs, as places in the whole string
        at, under = 0, ""
        for run in got["mask"]:
            under += got["formatted"][at + run["skip"] : at + run["skip"] + run["take"]]
            at += run["skip"] + run["take"]
        assert at == len(got["formatted"])
        assert re.sub(r"<\\(\\*)\|", r"<\1|", under) == got["loss"] or "a<|b" in got["loss"] or "<|b" in got["loss"]
        assert got["formatted"].count("<|im_start|>") == len(said)


def test_chat_order_is_by_turn_then_role_then_text(spark):
    rows = [(1, 2, "user", "c"), (1, None, "user", "a"), (1, 1, "assistant", "z"), (1, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    done = chat.conversations(chat.format_turns(df, chat.text_part(F.col("text"))))
    assert chat.read_back(done).first()["turns"] == "user\na\nassistant\nb\nassistant\nz\nuser\nc\n"


def test_chat_parts_leave_placeholders_in_order(spark):
    content = """[{"kind":"text","text":"a<|"},{"kind":"text","text":"|b"},{"kind":"image","ref":"i1","width":57,
      "height":28},null,{"kind":"text","text":""},{"kind":"audio","ref":"s","seconds":1.5},{"kind":"text","text":"end"},
      {"kind":"document","ref":"d","pages":3},{"kind":"video","ref":"v"},{"ref":"n"}]"""
    rows = [(1, 1, "assistant", content), (1, 2, "user", "[not json"), (1, 3, "user", None), (1, 4, "user", "[]")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, content string")
    done = chat.conversations(chat.format_turns(df, chat.json_parts(F.col("content")))).collect()[0]
    assert done["formatted"] == (
        "<|im_start|>assistant\na<\\|<|part|>|b<|image|><|audio|><|part|>end<|document|><|other|><|other|><|im_end|>\n"
        "<|im_start|>user\n[not json<|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    )
    assert [tuple(a) for a in done["attachments"]] == [
        ("image", "i1", 3), ("audio", "s", 38), ("document", "d", 1536), ("other", "v", 0), ("other", "n", 0),
    ]
    assert done["n_expanded"] == 3 + 38 + 1536
    back = chat.read_back(spark.createDataFrame([done]), "conv_id").collect()[0]
    assert back["loss"] == "a<||bend" and back["n_turns"] == 4


def test_chat_of_no_rows(turns):
    df, _ = turns
    none = chat.conversations(chat.format_turns(df.where("false"), chat.text_part(F.col("text"))))
    assert chat.read_back(none, "conv_id").count() == 0


def test_chat_runs_no_python(spark, tmp_path):
    rows = [(1, 1, "user", "x")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    plan = QUERIES["op11_chat"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- structure ----------------------------------------------------------------------

GRAMMAR = re.compile("(s?(ua)+)?")


def best_by_search(rows):
    """Least cost, and then least audit, over all edits: a search by cost and audit."""
    import heapq

    fault = structure.faults(rows)
    heap, seen = [(0, "", 0, ())], set()
    while heap:
        cost, audit, at, out = heapq.heappop(heap)
        initials = "".join(r[:1] or "-" for r, _ in out)
        if at == len(rows) and GRAMMAR.fullmatch(initials):
            return cost, audit, list(out)
        # a partial result that no ending can mend
        if not re.fullmatch("s?(ua)*u?", initials):
            continue
        state = (at, len(initials) > 0, initials[-1:])
        if state in seen:
            continue
        seen.add(state)
        if at < len(rows):
            role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, out))
            if fault[at] not in (structure.BLANK, structure.DUPLICATE):
                more = fault[at] == structure.TRUNCATED
                if role[:1]:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, (*out, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, (*out, (new, text))))
        for new in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", at, (*out, (new, ""))))
    raise AssertionError


def test_repair_is_cheapest_and_least():
    rng = random.Random(5)
    texts = ["Hi.", "So?", "no end", "", " \n", "Yes!", "x. "]
    convs = [
        [
            (rng.choice(["user", "assistant", "system", "user", "assistant", "", " ", "tool"]), rng.choice(texts) + rng.choice(["", f"{k}."]))
            for k in range(rng.randint(0, 9))
        ]
        for _ in range(400)
    ]
    for conv, got in zip(convs, structure.repair_batch(convs), strict=True):
        cost, audit, out = best_by_search(conv)
        assert (got["cost"], got["audit"]) == (cost, audit), conv
        assert list(zip(got["roles"], got["texts"], strict=True)) == out
        assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in out))


def test_ranks_are_those_of_the_least_audits():
    rows = [("assistant", f"a{k}.") for k in range(5)] + [("user", "b")] * 3
    cost = np.array(structure.costs([r[:1] for r, _ in rows], structure.faults(rows)))
    end = np.arange(len(rows) + 1) == len(rows)
    arcs = structure.optimal_arcs(
        cost, np.array([*(r[:1] for r, _ in rows), ""]), np.array([*structure.faults(rows), -1]), end
    )
    ranks, label = structure.rank(arcs)
    after = structure.successors(arcs, ranks, label)
    audits = {}
    for node in range(cost.size):
        audit, at = "", node
        while label.ravel()[at] >= 0:
            audit, at = audit + structure.EDITS[label.ravel()[at]], after[at]
        audits[node] = audit
    pairs = itertools.combinations(range(cost.size), 2)
    assert all((ranks.ravel()[i] < ranks.ravel()[j]) == (audits[i] < audits[j]) for i, j in pairs)


def test_long_conversation():
    rng = random.Random(1)
    conv = [(rng.choice(["user", "assistant"]), f"{k}{rng.choice(['.', ''])}") for k in range(5000)]
    got = structure.repair_batch([conv, [], conv[:3]])
    assert len([e for e in got[0]["audit"] if e != "I"]) == 5000 and got[1]["audit"] == ""
    assert GRAMMAR.fullmatch("".join(r[0] for r in got[0]["roles"]))


def test_repair_query_on_odd_rows(spark, tmp_path):
    import zlib

    rng = random.Random(8)
    rows = [
        (c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["A b. c!", "Nope", None, " ", "Zwei?"]))
        for c in range(120)
        for t in [*range(rng.randint(1, 7)), *([None] if c % 9 == 0 else [])]
    ] + [(None, 1, "user", "x."), (None, None, None, None), (5, 0, "user", "again."), (5, 0, "user", "again.")]
    spark.createDataFrame(
        [(*r, "p", 1, "r", "t") for r in rows],
        "conv_id bigint, turn bigint, role string, text string, present string, kind int, roles string, texts string",
    ).write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r["conv_id"]: r for r in QUERIES["op12_structure"](spark, str(tmp_path)).collect()}
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn is not None, turn or 0, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert found.keys() == convs.keys()
    for conv, damaged in convs.items():
        damaged = sorted(damaged)
        left = [(r, t) for _, _, r, t in damaged]
        cost, audit, out = best_by_search(left)
        turns = {t for known, t, _, _ in damaged if known}
        fault = structure.faults(left)
        got = found[conv]
        want = {
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            "blank": sum(not t.strip(" \t\n\x0b\x0c\r") for _, t in left),
            "duplicate": sum(bool(t.strip()) and (r, t) in left[:k] for k, (r, t) in enumerate(left)),
            "truncated": fault.count(structure.TRUNCATED),
            "illegal": sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(left, left[1:])),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
        }
        assert {k: got[k] for k in want} == want


def test_repair_of_no_rows(turns):
    assert structure.repair(turns[0].where("false")).count() == 0


# --- alignment ----------------------------------------------------------------------

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligned_plainly(texts):
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = {c: bytes([n]) for c, n in align._letters().items()}
    out, counts = [], collections.Counter()
    for text in texts:
        ends = []
        for ids, raw in (
            (i := a.encode(" " + (text or ""), add_special_tokens=False).ids, [b"".join(letters[c] for c in a.id_to_token(x)) for x in i]),
            (i := b.encode(text or ""), [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, i)]),
        ):
            ends.append((ids, list(itertools.accumulate(map(len, raw))), b"".join(raw)))
        (ia, ea, ra), (ib, eb, rb) = ends
        if not text or not ra == rb == (" " + text).encode():
            out.append((0, 0, [], ""))
            continue
        links = [(x, y) for x, e in zip(ia, ea) for y in [dict(zip(eb, ib)).get(e)] if y is not None] if len(ia) < 3000 else None
        if links is None:
            at_b = dict(zip(eb, ib))
            links = [(x, at_b[e]) for x, e in zip(ia, ea) if e in at_b]
        both = sorted(set(ea) & set(eb))
        groups, low = [], 0
        if len(ia) < 3000:
            for high in both:
                groups.append(",".join(str(x) for x, e in zip(ia, ea) if low < e <= high) + "|" + ",".join(str(x) for x, e in zip(ib, eb) if low < e <= high))
                low = high
        counts.update(links)
        out.append((len(ia), len(ib), links, ";".join(groups)))
    best = collections.defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (na, nb, len(links), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), groups)
        for na, nb, links, groups in out
    ]


def odd_texts():
    rng = random.Random(11)
    bits = ["the", "Über", " ", "  ", "\n", "\t", " \n ", "x1", "<|endoftext|>", "</s>", "é", "é", "😀", "\x00", "\x1c", " ", "\xa0", "don't", "<0x41>", "12345", "ß", "中文", "'s", "...", "　"]
    out = [None, "", " ", "\n", "a", " a", "a ", "▁", "a▁b c", "the the the", "<s> <|endoftext|> </s>", "a" * 700]
    out += ["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(300)]
    out += [" ".join(rng.choices(["the", "of", "tion", "ing,", "Haus.", "1999"], k=n)) for n in (3, 50, 700)]
    return out + out[-30:]


def test_alignment_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(align, "TOGETHER", 2)
    texts = odd_texts()
    schema = "doc_id bigint, text string, chunk string, place int, radix int, groups string, slice string"
    rows = [(None if k == 3 else k // 2 * 2, t, "c", 1, 2, "g", "s") for k, t in enumerate(texts)]
    found = align.align(spark.createDataFrame(rows, schema).repartition(7), *PATHS).collect()
    want = aligned_plainly(texts)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    got = sorted(repr((r["doc_id"], *(r[n] for n in names))) for r in found)
    assert got == sorted(repr((r[0], *w)) for r, w in zip(rows, want, strict=True))


def test_alignment_of_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert align.align(none, *PATHS).count() == 0


def test_merge_counts_in_order(monkeypatch):
    monkeypatch.setattr(align, "FRAME", 3)
    rng = random.Random(2)
    runs = [collections.Counter(rng.choices(range(40), k=n)) for n in (50, 0, 7, 100)]
    frames = [align._run_of(iter(sorted(r.items()))) for r in runs]
    total = sorted(sum(runs, collections.Counter()).items())
    assert list(align._merged(frames)) == total
    codes, counts = align._whole(align._run_of(iter(total)))
    assert list(zip(codes.tolist(), counts.tolist(), strict=True)) == total


# --- queries with SQL ---------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_its_sql(spark, name):
    from compare import database, same

    folder = "/root/testdata/sf0.001"
    assert same(spark, database(folder), QUERIES[name], CHECKS[name], folder) == ""
