"""Personal data in very long texts, clashing columns, and a plain replacement to compare with."""

import re

import pytest

from metaloom.llm.pii import EMAIL, ENTITY, IPV4, replace_private

LONG = [
    (1, "1 x@" + "a." * 2000 + "com"),
    (2, "mail x@" + "b." * 300_000 + "com end"),
    (3, "password: " + "Ab1_" * 200_000),
    (4, "9" * 600_000),
    (5, "a" * 600_000 + "@x.com tail"),
    (6, "+" + "1 " * 300_000),
    (7, "Mr " + "A" * 600_000),
    (8, "1." * 300_000 + "1 at 10.1.2.3 version 1.2.3.4 v1.2.3.4"),
    (9, "a@" * 200_000 + " token"),
    (10, "(555) 123-4567 " * 30_000),
    (11, "a@b.co," * 30_000),
]


def test_no_length_is_too_long(spark):
    rows = {r.doc_id: r for r in replace_private(spark.createDataFrame(LONG, "doc_id long, text string"), "key").collect()}
    before = dict(LONG)
    assert set(rows) == set(before)
    assert {i: r.n_replaced for i, r in rows.items()} == {1: 1, 2: 1, 3: 1, 4: 0, 5: 1, 6: 1, 7: 1, 8: 1, 9: 0, 10: 30_000, 11: 30_000}
    assert rows[1].text[:4] == "1 " + rows[1].text[2] + "@" and rows[1].text.endswith("com") and len(rows[1].text) == 4007
    for i in (2, 3, 5):
        assert before[i][10:5000] not in rows[i].text
    assert rows[2].text.endswith("com end") and rows[5].text.endswith("@" + rows[5].text.split("@")[1]) and rows[5].text.endswith(" tail")
    assert "10.1.2.3" not in rows[8].text and rows[8].text.endswith("version 1.2.3.4 v1.2.3.4")
    assert len(set(rows[10].text.split(" (555) "))) == 1 and "123-4567" not in rows[10].text
    assert len(set(rows[11].text.split(",")[:-1])) == 1


NAMES = ("found", "gaps", "row", "list", "new", "made", "_found", "_new", "raw", "seed", "stream", "kind", "canon", "TEXT2", "_key_hash")


def test_clashing_columns_stay(spark):
    texts = ["mail a.b@example.com", None, "nothing", "call +1 301 555 0346 or Mr Smith", "mail a.b@example.com"]
    rows = [(i, t, *range(i, i + len(NAMES))) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "n_replaced int, body string, " + ", ".join(f"`{n}` long" for n in NAMES))
    out = replace_private(df, "key", text="body")
    assert out.columns == ["body", *NAMES, "n_replaced"]
    got = sorted(out.collect(), key=lambda r: r.found)
    assert [tuple(r)[1:-1] for r in got] == [r[2:] for r in rows] and [r.n_replaced for r in got] == [1, 0, 0, 2, 1]
    assert got[0].body == got[4].body != texts[0] and got[1].body is None and got[2].body == "nothing"
    assert re.fullmatch(r"call \+1 \d{3} \d{3} \d{4} or Mr [A-Z][a-z]+n?k", got[3].body)


def test_a_column_alone(spark):
    out = replace_private(spark.createDataFrame([("a@b.org",), ("x",)], "text string"), "key")
    assert out.columns == ["text", "n_replaced"] and sorted(r.n_replaced for r in out.collect()) == [0, 1]


def test_like_a_plain_replacement(spark):
    """What is replaced is what the patterns match, in order; equal entities are replaced alike, others differently."""
    people = [f"user{i}@host{i % 7}.org" for i in range(40)]
    numbers = [f"10.0.{i}.{i + 1}" for i in range(40)]
    texts = [f"{people[i % 40]} met {people[(i * 7) % 40]} at {numbers[(i * 3) % 40]}; also ftp {i}" for i in range(120)]
    rows = replace_private(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "key").collect()
    plain = re.compile(f"{EMAIL}|{IPV4}")
    made = {}
    for row in rows:
        found = plain.findall(texts[row.doc_id])
        assert row.n_replaced == len(found) == 3 and plain.split(texts[row.doc_id]) == plain.split(row.text)
        for old, new in zip(found, plain.findall(row.text), strict=True):
            assert made.setdefault(old, new) == new
    assert len(set(made.values())) == len(made) == 80 and not set(made.values()) & set(made)
    assert len({v.split("@")[1] for k, v in made.items() if "@" in k}) == 7


@pytest.mark.parametrize("text", ["", "plain words only", "@", "a@b", "Mr", "password:", "+1", "a@b..c", "x" * 100_000])
def test_nothing_to_replace(spark, text):
    row = replace_private(spark.createDataFrame([(text,)], "text string"), "key").first()
    assert (row.text, row.n_replaced) == (text, 0) and ENTITY
