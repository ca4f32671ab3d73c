"""Reversible template, windows, targets exactly once, digests by hand."""

import hashlib

from hypothesis import given, strategies as st

from tablemover.llm import chat


@given(st.lists(st.sampled_from(["<", "\\", "/", "turn", "</turn>\n", "<turn user>\n", "x", "\n", "é"]), max_size=12).map("".join),
       st.text(max_size=5))
def test_escape_is_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text
    s, a, b = chat.format_turn(role, text)
    assert chat.parse_turns(s + s) == [(role, text)] * 2 and chat.unescape(s[a:b]) == text


def _rows():
    rows = [(1, k, ["user", "assistant"][k % 2], f"word{k} " * (k % 9 + 1)) for k in range(60)]
    rows += [(2, 0, "system", "be kind"), *[(2, k, ["assistant", "user"][k % 2], "</turn> a b c " * k) for k in range(1, 40)]]
    rows += [(3, 0, "assistant", "long " * 5000), (3, 1, None, None), (3, None, "tool", "first"), (3, 1, "user", "tie"), (3, 1, "user", "tie"),
             (None, 0, "user", "no id"), (None, 1, "assistant", "")]
    return rows


def _expected(rows):
    out = {}
    none_first = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:])
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=none_first)
        all_ = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(all_.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark):
    rows = _rows()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as window")
    for budget, history in ((64, 16), (512, 128), (10 ** 9, 0)):
        w = chat.format_chats(turns, budget=budget, history=history)
        got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(w).collect()}
        assert got == _expected(rows)


def test_windows(spark):
    turns = spark.createDataFrame(_rows(), "conv_id long, turn long, role string, text string")
    ws = sorted(chat.format_chats(turns, budget=64, history=16).where("conv_id = 2").collect(), key=lambda r: r["window"])
    assert len(ws) > 3 and [r["window"] for r in ws] == list(range(len(ws)))
    before = None
    for r in ws:
        parsed = chat.parse_turns(r["formatted"])
        assert parsed[0] == ("system", "be kind")  # retained in every window
        if before is not None:
            lead = parsed[1:r["repeated"]]
            assert lead == before[len(before) - len(lead):]
        spans = [chat.unescape(r["formatted"][s["start"]:s["end"]]) for s in r["loss"]]
        assert spans == [t for role, t in parsed[r["repeated"]:] if role == "assistant"]
        before = parsed[1:]
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_tokenizer_is_a_parameter():
    assert chat.token_counter(None)("Hello, big world!") == 5


def test_windows_hold_the_budget(spark):
    rows = [(1, 0, "user", "a " * 380), (1, 1, "assistant", "b " * 380), (2, 0, "system", "s " * 40)]
    rows += [(2, k, ["assistant", "user"][k % 2], f"w{k} " * (k * 37 % 300 + 1)) for k in range(1, 80)]
    rows += [(3, 0, "system", "s " * 200), (3, 1, "user", "u " * 100), (3, 2, "assistant", "t " * 400), (3, 3, "user", "v " * 600),
             (3, 4, "assistant", "w " * 300), (3, 5, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ws = chat.format_chats(turns).collect()
    over = []
    for r in ws:
        parsed = chat.parse_turns(r["formatted"])
        assert r["n_tokens"] == sum(len(t.split()) for _, t in parsed)
        if r["n_tokens"] > 512:
            over.append((r["conv_id"], r["repeated"], [t[0] for _, t in parsed]))
    # Only turns that do not fit beside the system turn, alone with it.
    assert sorted(over) == [(3, 1, ["s", "t"]), (3, 1, ["s", "v"])]
    assert sum(r["conv_id"] == 1 for r in ws) == 2
    assert any(r["repeated"] > 1 for r in ws)  # history is still repeated where it fits
