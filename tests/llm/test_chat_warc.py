import hashlib
import random

import pytest

from quizlake.llm import chat, warc
from quizlake.llm.store import table
from tests.llm.helpers import SF01


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn if turn is not None else -10 ** 9, role or "", text or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss)))
    return sorted(out, key=repr)


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "more"), (1, 3, "assistant", "<|end|> &lt;|turn|>"), (1, 4, "user", "bye"),
    (2, 0, "system", None), (2, 1, "user", "only a question"), (3, 0, "assistant", ""), (4, 0, None, None),
    (None, 0, "user", "x"), (None, 1, "assistant", "y"), (5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "assistant", "c"),
    (5, None, "user", "no number"), (6, 0, "Assistant", "other role"), (7, 0, "user", "<|text|>&amp;&"), (7, 1, "assistant", "\U0001F600é\n\n<"),
    (7, 1, "assistant", "\U0001F600é\n\n<"), (8, 0, "user", "long " * 20_000), (8, 1, "assistant", "reply " * 20_000),
]


def test_digest_reads_everything_back(spark):
    df = spark.createDataFrame([(*r, "clash") for r in ROWS], "conv_id long, turn long, role string, text string, turns string")
    got = chat.digest(chat.expand(df)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(ROWS)
    assert chat.digest(chat.expand(df.where("false"))).count() == 0


def test_examples_train_on_one_reply_each(spark):
    df = spark.createDataFrame(ROWS[:5], "conv_id long, turn long, role string, text string")
    ex = sorted(chat.expand(df).collect(), key=lambda r: (r["target"] is None, r["target"]))
    assert [r["target"] for r in ex] == [2, 4, None]
    assert [r["formatted"][r["loss_start"]:r["loss_start"] + r["loss_chars"]] for r in ex[:2]] == ["hello", "&lt;|end|> &amp;lt;|turn|>"]
    assert ex[1]["formatted"].startswith(ex[0]["formatted"]) and ex[2]["loss_start"] is None


def test_random_texts_survive(spark):
    rng = random.Random(5)
    parts = ["<", "&", "lt;", "amp;", "|end|>", "<|end|>", "<|turn|>", "<|text|>", "\n", "a", "é", "\\E", "$1"]

    def some():
        return "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))

    rows = [(c, t, rng.choice(["user", "assistant", some()]), some()) for c in range(60) for t in range(rng.randint(1, 7))]
    got = chat.digest(chat.expand(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows)


def test_given_conversations(spark):
    got = {r["conv_id"]: r for r in chat.op5_prefix_targets(spark, SF01).collect()}
    rows = [tuple(r) for r in table(spark, SF01, "conversations").select("conv_id", "turn", "role", "text").collect()]
    text = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    assert sorted((tuple(r)[:5] for r in got.values()), key=repr) == brute(rows)


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/x", "<html><head><title>T &amp; t</title><style>p{}</style></head><body><p>One<br>two</p><!-- no --><script>if (a<b) \"</p>\"</script>"
          "<a href='q'>li&eacute;</a></body>", 9), (2, None, None, 9), (3, "http://b/\r\nX-Bad: 1", "plain < text", 9), (4, "u", "", 9), (4, "u", "", 9)],
        "page_id long, url string, html string, record int")
    rows = warc.derive(warc.responses(pages)).collect()
    assert len(rows) == 10 and all(r["error"] is None and r["digest_ok"] for r in rows)
    sources = {r["page_id"]: warc.read_record(bytes(r["response"])) for r in warc.responses(pages).collect()}
    for r in rows:
        headers, block = warc.read_record(bytes(r["record"]))
        h = dict(headers)
        assert h["WARC-Refers-To"] == r["refers_to"] == dict(sources[r["page_id"]][0])["WARC-Record-ID"]
        assert h["WARC-Block-Digest"] == warc.digest(block) == r["block_digest"] and len(block) == r["content_length"]
        assert h["WARC-Source-Payload-Digest"] == r["source_digest"]
        assert {x["record_id"] for x in rows if x["refers_to"] == r["refers_to"]} == {h["WARC-Record-ID"], h["WARC-Concurrent-To"]}
        assert "X-Bad" not in h
    text = {(r["page_id"], r["warc_type"]): warc.read_record(bytes(r["record"]))[1].decode() for r in rows}
    assert text[1, "conversion"] == "T & t\nOne\ntwo\nlié" and text[2, "conversion"] == "" and text[3, "conversion"] == "plain < text"
    assert "http-status: HTTP/1.1 200 OK\r\n" in text[1, "metadata"] and "title: T & t\r\n" in text[1, "metadata"]
    assert "links: 1\r\n" in text[1, "metadata"] and "http-header: Content-Type: text/html; charset=utf-8\r\n" in text[1, "metadata"]


@pytest.mark.parametrize("raw", [b"", b"junk", b"WARC/1.0\r\nWARC-Type: request\r\nContent-Length: 0\r\n\r\n",
                                 b"WARC/1.0\r\nno colon\r\n\r\n", b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nabc"])
def test_bad_records_are_reported(spark, raw):
    rows = warc.derive(spark.createDataFrame([(1, bytearray(raw))], "page_id long, response binary")).collect()
    assert len(rows) == 1 and rows[0]["error"] and rows[0]["record"] is None


def test_altered_payload_is_marked(spark):
    raw = warc.response_record("u", "<p>text</p>", warc.CAPTURED, "1").replace(b"text", b"TEXT")
    rows = warc.derivatives(raw)
    assert [r["digest_ok"] for r in rows] == [False, False]
    assert warc.derive(spark.createDataFrame([], "page_id long, response binary")).count() == 0


def test_digests_equal_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF01}/conversations.parquet'")
    want = {r[0]: r for r in con.execute(chat.OP5_SQL).fetchall()}
    got = {r[0]: tuple(r) for r in chat.op5_prefix_targets(spark, SF01).collect()}
    assert got == want and len(got) > 50
