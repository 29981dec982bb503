import base64
import hashlib
import re

from pyspark.sql import functions as F

from cartwise.llm import chat, line_dedup, url_rules

DOCS = "doc_id long, text string, lang string, n_lines string, rest string"


def _lines_by_hand(docs, min_docs, min_chars=1):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for row in docs:
        for line in (row[1] or "").split("\n"):
            holders.setdefault(key(line), set()).add(row[0])
    out = []
    for row in docs:
        lines = (row[1] or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs]
        out.append((row[0], "\n".join(kept), row[2], row[4], len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_lines_dropped_like_by_hand(spark):
    docs = [(i, f"Share É\n own {i}\n\nshare É \t\n  SHARE É", "en", "x", "y") for i in range(5)]
    docs += [(5, None, None, None, None), (6, "", "en", "x", "y"), (None, "share É", "en", "x", "y")]
    docs += [(0, docs[0][1], "en", "x", "y"), (7, "repeated\n" * 30_000 + "own 3", None, "x", "y"), (8, "share É\n", "x", "y", "z")]
    for min_docs, min_chars in ((5, 1), (2, 1), (2, 8), (7, 1)):
        found = line_dedup.dedup_lines(spark.createDataFrame(docs, DOCS), min_docs, min_chars)
        assert found.columns == ["doc_id", "text", "lang", "rest", "n_lines", "n_dropped"]
        assert sorted(map(tuple, found.collect()), key=str) == _lines_by_hand(docs, min_docs, min_chars)


def test_lines_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).collect() == []


def test_chat_reads_back_every_turn(spark):
    rows = [
        (1, 2, "assistant", "b < &lt; </turn>\n<next>"), (1, 0, "system", "s"), (1, 1, "user", None),
        (2, 0, "user", "a"), (2, 1, "user", "b\n>\n"), (2, 2, "assistant", ""), (2, 2, "assistant", ""),
        (2, 3, "assistant", "é🎉"), (None, None, None, None), (3, 0, "<r>&\n", "<turn user>\n" * 2_000),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_conversations(frame)
    assert out.columns == ["conv_id", "formatted", "loss_mask"]
    back = out.select(
        "*", chat.turns_of(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    ).collect()
    for r in back:
        turns = sorted(
            ((t, role, text) for c, t, role, text in rows if c == r.conv_id), key=lambda x: (x[0] is not None, x[0] or 0, x[2] or "")
        )
        turns = [(role or "", text or "") for _, role, text in turns]
        assert [tuple(t) for t in r.turns] == turns
        assert r.loss == "".join(text for role, text in turns if role == "assistant")
        assert sum(run.chars for run in r.loss_mask) == len(r.formatted)
    two = next(r for r in back if r.conv_id == 2)
    assert two.formatted == "<turn user>\na<next>b\n>\n</turn>\n<turn assistant>\n<next><next>é🎉</turn>\n"
    empty = chat.format_conversations(frame.limit(0))
    assert empty.collect() == []


def test_chat_uses_no_python(spark):
    frame = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.format_conversations(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_url_rules_like_by_hand(spark):
    rules = [
        ("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.b", "", "block"), ("a.b", "/x", "allow"), (None, "/", "block"),
        ("net", "/", None), ("q.net", "/a.*/", "block"), ("org", "/s/t/", "block"), ("org", "/s/t/", "allow"),
    ]
    urls = [
        "http://x.example.net/en/1", "https://EXAMPLE.net/en", "http://example.net/en/?q#f", "http://notexample.net/", "ftp://a.net",
        "http://c.a.b?x", "http://a.b/xyz", "http://da.b/xyz", "no url", None, "", "http:///p", "x://y.org/s/t/u", "http://q.net/abc/",
        "http://q.net/a.*/", "http://u\nv.net/é", "http://a.b/" + "p/" * 5_000, "HTTP://É.NET/://x.org/",
    ]

    def judged(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = m.groups() if m else ("", "")
        host = re.sub("[A-Z]", lambda x: x[0].lower(), host)
        fit = [
            (len((h or "") + p), v, (h or "") + p) for h, p, v in rules
            if v and (host == (h or "") or h and host.endswith("." + h) or not h and host.endswith(".")) and path.startswith(p)
        ]
        best = max(fit, default=(0, "allow", None))
        return host, path, best[2], best[1]

    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, verdict string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = url_rules.judge(pages, table)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert {r.page_id: tuple(r)[2:] for r in found.collect()} == {i: judged(u) for i, u in enumerate([*urls, urls[0]])}
    assert url_rules.judge(pages.limit(0), table).collect() == []
    assert {r.verdict for r in url_rules.judge(pages, table.limit(0), "block").collect()} == {"block"}


def test_rules_are_posted_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("a.net", "/en/1"), ("b.net", "/en/2"), ("c.net", "/fr/")], "host string, path string")
    rules = spark.createDataFrame([("net", "/fr/", "block"), ("c.net", "/en/", "allow")], "host string, path string, verdict string")
    assert {r.rule: r.token for r in url_rules.rule_index(rules, urls).collect()} == {"net/fr/": "path fr", "c.net/en/": "host c"}


def test_digest_is_bare_base32():
    from cartwise.llm.warc import digest_of

    assert digest_of(b"x") == base64.b32encode(hashlib.sha1(b"x").digest()).decode()
