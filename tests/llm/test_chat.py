import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from flickmill.llm import chat, registry

words = st.text(alphabet="\\#<>/:aturn \n🙂é", max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(words, words), max_size=5))
def test_round_trip_and_spans(turns):
    out, spans, rewritten = chat.spans(turns, chat.hashes_template)
    assert not rewritten
    assert chat.read_back(out) == turns
    assert [chat.unescape(out[a:b]) for _, _, a, b in spans] == [t for _, t in turns]
    assert "".join(out[a:b] for a, b, _, _ in spans) == out


def test_rewriting_template_is_detected():
    def last_only(turns):  # shows the system turn beside the last one alone
        return "".join(f"[{r}:{t}]" for i, (r, t) in enumerate(turns) if r != "system" or i == len(turns) - 1)

    out, spans, rewritten = chat.spans([("system", "s"), ("user", "u"), ("assistant", "a")], last_only)
    assert rewritten and out == "[user:u][assistant:a]"
    assert out[spans[2][2]:spans[2][3]] == "a" and spans[1][2] == spans[1][3]
    assert all(0 <= a <= b <= len(out) for s in spans for a, b in (s[:2], s[2:]))


def expected(turns):
    learnt = "".join(t or "" for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest(),
            len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


def test_edge_rows(spark):
    rows = [(1, 0, "user", None, "x"), (1, 1, "assistant", "", "x"), (2, None, None, "a\\", "x"), (2, 0, "assistant", "z" * 100_000, "x"),
            (None, 0, "user", "q", "x"), (3, 0, "user", "same", "x"), (3, 0, "user", "same", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r[2:6] for r in chat.digest(chat.formatted(df)).collect()}
    assert got == {k: expected([(r[2], r[3]) for r in rows if r[0] == k]) for k in (1, 2, None, 3)}
    assert chat.digest(chat.formatted(df.limit(0))).count() == 0


def test_query(spark, sf_dir):
    got = {r.conv_id: r[2:6] for r in registry.QUERIES["op2_chat_formatting"](spark, sf_dir).collect()}
    turns = {}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    turns[-7] = [(r, "\\### Assistant: </turn> ok") for r in ("user", "assistant")]
    assert got == {k: expected(v) for k, v in turns.items()}
