"""URL filters, quality rules, chat formatting and line dedup."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.compare import connect, same
from tests.llm.helpers import awkward, prose, table
from tickforge.llm import chat, lines, quality, registry, urls

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_against_sql(spark, name):
    same(registry.QUERIES[name](spark, FOLDER), connect(FOLDER), registry.ORACLE_SQL[name])


def test_chat_sql_on_awkward_turns(spark, tmp_path):
    """What the SQL and the query say of control strings, nulls, repeated turns and odd roles."""
    rng = random.Random(31)
    parts = [*chat.CONTROL, "\\", "|", "<", "[", "é", "\n", " ok ", "INST", "/s>", ""]
    rows = [(c, rng.choice([None, 0, 1, 1, 2]), rng.choice(["user", "assistant", "a|b<", None]), rng.choice([None, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))])) for c in [1, 2, 3, None] for _ in range(12)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    same(registry.QUERIES["op4_chat_format"](spark, str(tmp_path)), con, registry.ORACLE_SQL["op4_chat_format"])


@pytest.mark.parametrize("name", ["op1_url_filter", "op8_line_dedup", "op9_quality_rules"])
def test_native_plans_have_no_python(spark, name):
    plan = registry.QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_urls(spark):
    rows = [
        (1, "http://WWW.Example.com/en/a?x#y", "www.example.com/en/", "allow"), (2, "https://m.example.com/en/", "example.com/en/", "block"), (3, "http://example.com/de/", "com/", "allow"),
        (4, "http://a.net/es/x", "net/es/", "block"), (5, "http://notexample.com/en/x", "com/", "allow"), (6, "http://com", None, None), (7, None, None, None), (8, "no scheme", None, None),
        (9, "http://a.net/en/?/es/", None, None), (9, "http://a.net/en/?/es/", None, None), (None, "x://net/fr/", "net/fr/", "block"), (10, "http://h?a/b://c/d", None, None),
    ]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u, _, _ in rows], "page_id long, url string, host string, bound string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = urls.filter_urls(pages, urls.page_outcomes(pages, labels)).collect()
    assert sorted((str(r["page_id"]), r["rule"] or "") for r in got) == sorted((str(i), r or "") for i, _, r, _ in rows)
    assert {r["page_id"]: r["verdict"] for r in got if r["rule"]} == {i: v for i, _, _, v in rows if v}
    by = {r["page_id"]: r for r in got}
    assert (by[10]["host"], by[10]["path"]) == ("h", "") and (by[7]["host"], by[7]["path"]) == ("", "") and (by[1]["host"], by[1]["path"]) == ("www.example.com", "/en/a")
    assert urls.filter_urls(pages.limit(0), urls.page_outcomes(pages, labels)).count() == 0


def test_bounds_are_quantiles(spark):
    import numpy as np

    rng = np.random.default_rng(33)
    pairs = [(a, b) for a in (1.0, 1.7, 3.0, 20.0, 400.0) for b in (1.0, 2.5, 9.0, 60.0)] + [(0.3, 5.0), (5.0, 0.4), (0.01, 0.99)]
    got = [r[0] for r in spark.createDataFrame(pairs, "a double, b double").select(urls.lower_bound("a", "b")).collect()]
    for (a, b), x in zip(pairs, got, strict=True):
        if min(a, b) >= 1:
            assert (0.04 if min(a, b) > 1 else 0.015) < (rng.beta(a, b, 200_000) < x).mean() < 0.055
        assert 0 <= x < a / (a + b)


def test_long_rule_lists_are_joined(spark, monkeypatch):
    rng = random.Random(30)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "com", "x.org", "y.x.org", "", "a..com", "com."]
    rules = sorted({(f"{rng.choice(hosts[:-3])}/{rng.choice(['', 'e', 'en', 'en/', 'de/x'])}", "allow") for _ in range(25)})
    rules = [(r, rng.choice(("allow", "block"))) for r, _ in rules]
    rows = [(k, f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/e', '/en/x', '/de/x/y', '/DE', '?q'])}") for k in range(200)] + [(200, None)]
    pages, none = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([], "host string, good boolean")
    chain = urls.filter_urls(pages, none, rules).collect()
    monkeypatch.setattr(urls, "CHAIN", 3)
    assert sorted(map(str, urls.filter_urls(pages, none, rules).collect())) == sorted(map(str, chain)) and any(r["rule"] for r in chain)


def test_reputation_shrinks_towards_the_domain(spark):
    pages = spark.createDataFrame([(k, f"http://{h}.org/") for k, h in enumerate(["good.a"] * 40 + ["bad.b"] * 40 + ["new.b"] + ["new.c"])], "page_id long, url string")
    labels = spark.createDataFrame([(k, int(k < 40), 0) for k in range(80)] + [(0, None, None), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = {r["host"]: r for r in urls.filter_urls(pages, urls.page_outcomes(pages, labels)).collect()}
    assert got["good.a.org"]["verdict"] == "allow" and got["bad.b.org"]["verdict"] == "block"
    assert got["new.b.org"]["verdict"] == "block" and got["new.b.org"]["bound"] < got["good.a.org"]["bound"]  # its domain is all that is known


def base_counts(t):
    w = WORD.findall(t or "")
    win = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    rep = {i + o for i in range(len(w) - 2) if win[tuple(w[i : i + 3])] > 1 for o in range(3)}
    real = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t or ""), len(real) - len(set(real)), len(rep)


def test_quality(spark):
    rows = [*awkward(), (13, "a a a a"), (14, "a b c\na b c"), (15, "a b\x85c d")]
    got = quality.clean_lines(table(spark, rows)).collect()
    key = lambda r: (str(r[0]), *map(int, r[1:]))
    assert sorted(key((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])) for r in got) == sorted(key((i, *base_counts(t))) for i, t in rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] not in (None, 5)}
    assert by[10]["kept"] and by[8]["kept"] and not by[9]["kept"] and by[9]["base_failed"] and by[1]["base_failed"]
    assert quality.clean_lines(table(spark, [])).count() == 0


def test_quality_drops_lines_first(spark):
    text = prose(random.Random(3), 80)
    menu = "Home | About | News | Contact"
    got = quality.clean_lines(table(spark, [(1, f"{menu}\n{text}\nAll rights reserved."), (2, "\n".join([f"Home{k} | About{k} | News{k} | Contact{k}" for k in range(40)] + [text]))])).orderBy("doc_id").collect()
    assert got[0]["cleaned"] == text and got[0]["kept"] and got[1]["cleaned"] == text and not got[1]["kept"] and not got[1]["base_failed"]


@given(st.text(alphabet="<|>[]/\\INSTs ok\n", max_size=40), st.text(alphabet="us|<>\\[\n", max_size=8))
def test_escape_is_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROL)
    one = chat.render_turn(role, text)
    assert [(r, t) for r, t, *_ in chat.parse_turns(one + one)] == [(role, text)] * 2


def test_fold_events(spark):
    rows = [
        (1, 0, "a", "message", "user", "hi"), (1, 1, "b", "message", "assistant", "He"), (1, 2, "b", "delta", None, "llo"), (1, 3, "b", "regenerate", None, None), (1, 4, "b", "delta", None, "Bye"),
        (1, 5, "a", "edit", None, "hey"), (1, 6, "c", "message", "user", "x"), (1, 7, "c", "delete", None, None), (1, 8, "d", None, None, None), (None, 1, "a", "delta", "user", "z"),
    ]
    events = spark.createDataFrame(rows, "conv_id long, seq long, message_id string, kind string, role string, text string")
    got = [tuple(r) for r in chat.fold_events(events).orderBy("conv_id", "place").select("conv_id", "role", "text").collect()]
    assert got == [(None, "user", "z"), (1, "user", "hey"), (1, "assistant", "Bye"), (1, "", "")]
    assert [chat.parse_turns(r["formatted"])[0][:2] for r in chat.render(chat.fold_events(events)).filter("conv_id = 1").orderBy("place").collect()] == [("user", "hey"), ("assistant", "Bye"), ("", "")]


def folded(events):
    """Final messages of a log, event by event."""
    out = {}
    for conv, seq, message, kind, role, text in sorted(events, key=lambda e: (str(e[0]), e[1], e[3] or "message", e[5] or "", e[4] or "")):
        m = out.setdefault((conv, message), {"place": seq, "role": None, "text": "", "gone": False})
        m["text"] = (m["text"] if kind == "delta" else "") + ("" if kind == "delete" else text or "")
        m["gone"], m["role"] = kind == "delete", m["role"] if m["role"] is not None else role
    return {k: (m["place"], m["role"] or "", m["text"]) for k, m in out.items() if not m["gone"]}


def test_long_logs_against_brute_force(spark):
    """Deltas, edits, regenerations and deletions in any order, messages of very many deltas, and a conversation with most of all rows."""
    rng = random.Random(32)
    events = []
    for k in range(1500):
        kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate", "delete", None])
        events.append((rng.choice([1, 1, 1, 2, None]), k, rng.choice(["a", "b", "c", "d", None]), kind, rng.choice([None, "user", "assistant"]), rng.choice([None, "", "é ", "x", "</s>"])))
    events += [(9, k, "long", "delta", "assistant", f"{k} ") for k in range(30000)]
    df = spark.createDataFrame([(*e, "y") for e in events], "conv_id long, seq long, message_id string, kind string, role string, text string, place string").repartition(5)
    got = {(r["conv_id"], r["message_id"]): (r["place"], r["role"], r["text"]) for r in chat.fold_events(df).collect()}
    assert got == folded(events) and len(got[9, "long"][2]) > 150_000


def test_conversations(spark):
    rows = [(1, 1, "assistant", "</s>"), (1, 0, "user", None), (1, 1, "assistant", "</s>"), (1, 1, "assistant", "<|end|>\n"), (None, None, None, "q"), (2, 0, "system", "x" * 50000)]
    conv = spark.createDataFrame([(*r, "a", "b") for r in rows], "conv_id long, turn long, role string, text string, seq string, place string")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(conv)).collect()}
    told = [("user", ""), ("assistant", "</s>"), ("assistant", "</s>"), ("assistant", "<|end|>\n")]
    assert got[1]["n_turns"] == 4 and got[1]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in told).encode()).hexdigest()
    assert got[1]["loss_chars"] == 16 and got[1]["loss_sha256"] == hashlib.sha256(b"</s></s><|end|>\n").hexdigest()
    assert got[None]["n_turns"] == 1 and got[2]["formatted_chars"] > 50000 and chat.digests(chat.format_conversations(conv.limit(0))).count() == 0


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return a == b
    a, b = sorted((a, b), key=len)
    p = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


def expected_lines(rows, least):
    seen, out = [], {}
    for i, t in sorted(rows):
        kept = []
        for x in t.split("\n"):
            gone = WORD.search(x) and any(x == y or (min(len(x), len(y)) >= least and near(x, y)) for y in seen)
            if WORD.search(x):
                seen.append(x)
            if not gone:
                kept.append(x)
        out[i] = "\n".join(kept)
    return out


def test_lines_against_brute_force(spark):
    rng = random.Random(5)
    pool = [prose(rng, rng.randint(1, 14)).replace("\n", " ") for _ in range(60)] + ["é" * 24, "é" * 25, "ab" * 200] + ["".join(rng.choice("xy") for _ in range(rng.randint(1, 9))) for _ in range(25)]
    rows = []
    for i in range(120):
        picked = [rng.choice(pool) for _ in range(6)] + ["", "  "]
        for k in range(6):
            x, p = picked[k], rng.randrange(len(picked[k]) + 1)
            picked[k] = rng.choice([x, x[:p] + "q" + x[p:], x[:p] + x[p + 1 :], x[:p] + "z" + x[p + 1 :], x[:p] + "12" + x[p:]])
        rows.append((i, "\n".join(picked)))
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(table(spark, rows)).collect()}
    assert got == expected_lines(rows, lines.MIN_CHARS)


def test_short_lines(spark):
    rows = [(1, "Read more about us\nRead more about us!\nabcd\nabce\nabcde\nabcdef\n1.\n2."), (2, "Reed more about us\nabcd")]
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(table(spark, rows)).collect()}
    assert got == expected_lines(rows, lines.MIN_CHARS) == {1: "Read more about us\nabcd\nabce\nabcde\n1.\n2.", 2: ""}


def test_lines_awkward(spark):
    got = lines.dedup_lines(table(spark, awkward()))
    rows = got.collect()
    assert len(rows) == len(awkward()) and got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    by = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 5)}
    assert by[1]["text"] is None and (by[2]["text"], by[3]["text"]) == ("", " \n\t ") and by[4]["text"] == "" and by[11]["text"] == "Same line here again." and by[12]["n_lines"] == 1
    first = [r for r in rows if r["doc_id"] is None and len(r["text"]) > 100]
    assert len(first) == 1 and first[0]["n_removed"] == 0  # a missing id comes first
    assert lines.dedup_lines(table(spark, [])).count() == 0
