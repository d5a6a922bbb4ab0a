from holdfast.llm.url_rules import judge, mine

SCHEMA = "page_id bigint, url string"


def by_id(df):
    return {r["page_id"]: r for r in df.collect()}


def test_given_rules(frame):
    urls = {
        1: "https://a.ORG/x", 2: "https://example.org/es/1", 3: "http://www.Example.org/en/17?q#f", 4: "http://example.org/en/2", 5: "http://myexample.org/es/",
        6: "ftp://x.com/fr/", 7: "ftp://x.com/fr", 8: "ftp://com/de/9", 9: "no scheme.org/", 10: None, 11: "", 12: "http://org", 13: "http://a.b?x/://c.org/es/", 14: "http://x.org:80/",
    }
    got = by_id(judge(frame(list(urls.items()), SCHEMA)))
    assert {k: (r["host"], r["path"], r["rule"]) for k, r in got.items()} == {
        1: ("a.org", "/x", "org/"), 2: ("example.org", "/es/1", "example.org/es/"), 3: ("www.example.org", "/en/17", "example.org/en/1"),
        4: ("example.org", "/en/2", "org/"), 5: ("myexample.org", "/es/", "org/"), 6: ("x.com", "/fr/", "com/fr/"), 7: ("x.com", "/fr", None),
        8: ("com", "/de/9", "com/de/"), 9: ("", "", None), 10: ("", "", None), 11: ("", "", None), 12: ("org", "", None), 13: ("a.b", "", None), 14: ("x.org:80", "/", None),
    }
    assert got[2]["verdict"] == got[8]["verdict"] == "block" and got[4]["verdict"] == "allow"


def test_mined_rules_judge_the_rest(frame):
    rows = [(k, f"http://a{k}.com/de/casino/{k}") for k in range(40)] + [(100 + k, f"http://b{k}.org/news/{k}") for k in range(40)]
    rows += [(200, "http://c.net/casino/7"), (201, "http://c.net/news"), (202, "http://c.net/other"), (203, "http://c.net/casino/7"), (None, "http://d.net/casino")]
    rows += [(204, "http://c.net/" + "/".join(f"p{chr(97 + k % 26)}x" for k in range(3000)) + "/casino")]
    got = by_id(judge(frame(rows, SCHEMA), support=0.05))
    assert [got[k]["verdict"] for k in (200, 201, 202, 203, None, 204)] == ["block", "allow", "allow", "block", "block", "block"]
    assert got[200]["mined"] == "p:casino" and got[200]["confidence"] == 1.0 and got[202]["mined"] is None


def test_longer_rules_stay_only_if_surer(frame):
    rows = [(["a", "b"], "block")] * 8 + [(["a"], "block")] * 4 + [(["a", "c"], "allow")] * 2 + [(["b"], "allow")] * 6
    found = {tuple(r["tokens"]): (r["verdict"], round(r["confidence"], 3)) for r in mine(frame(rows, "tokens array<string>, verdict string"), 0.1, 0.8).collect()}
    assert found == {("a",): ("block", 0.857), ("a", "b"): ("block", 1.0), ("c",): ("allow", 1.0)}


def test_empty_tables_and_other_columns(frame):
    assert judge(frame([], SCHEMA)).collect() == []
    df = frame([("p", "http://x.org/a", 1, 2)], "page_id string, url string, host int, rule int")
    assert [(r["page_id"], r["host"], r["rule"]) for r in judge(df).collect()] == [("p", "x.org", "org/")]
    assert [r["verdict"] for r in judge(frame([(1, None)], SCHEMA)).collect()] == ["allow"]


def test_a_rule_may_need_four_tokens(frame):
    """Only all four together mean block; every three of them come in allowed URLs as often."""
    parts = ["aa", "bb", "cc", "dd"]
    rows = [(k, f"http://x{k}.com/de/{'/'.join(parts)}") for k in range(30)]
    for left_out in parts:
        rows += [(1000 + len(rows) + k, f"http://y{k}.org/{'/'.join(p for p in parts if p != left_out)}") for k in range(30)]
    rows += [(1, f"http://z.net/{'/'.join(parts)}"), (2, "http://z.net/aa/bb/cc")]
    got = [(r["page_id"], r["verdict"], r["mined"], r["confidence"]) for r in judge(frame(rows, SCHEMA), support=0.01).where("host = 'z.net'").collect()]
    assert sorted(got)[0] == (1, "block", "p:aa p:bb p:cc p:dd", 1.0)
    assert sorted(got)[1][1] == "allow"


def test_tokens_that_always_come_together_take_each_others_place(frame):
    """A long URL that comes again and again: one rule per token, and no more."""
    long = "/".join(f"s{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    rows = [([f"p:{x}" for x in long.split("/")], "block")] * 40 + [(["p:other"], "allow")] * 10
    found = mine(frame(rows, "tokens array<string>, verdict string"), 0.1, 0.8).collect()
    assert sorted(r["tokens"] for r in found) == sorted([[f"p:{x}"] for x in long.split("/")] + [["p:other"]])
    urls = [(k, f"http://x{k}.com/de/{long}") for k in range(30)] + [(100, "http://z.net/saa/other"), (101, "http://z.net/shc")]
    got = by_id(judge(frame(urls, SCHEMA)))
    assert got[100]["mined"] == "p:saa" and got[101]["mined"] == "p:shc" and got[101]["verdict"] == "block"
