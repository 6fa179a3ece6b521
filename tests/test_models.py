"""Random inputs against plain-Python models of what each operator means."""

import random
from datetime import datetime

import pytest

from metaloom import fixed_values as fv, schemas
from metaloom.operators.hierarchy import flatten, nest
from metaloom.operators.keys import keyed
from metaloom.operators.merge import apply_status, upsert_metadata, upsert_small_batch
from metaloom.operators.tags import default_tags, set_default_tags, untagged_tables
from metaloom.operators.targets import eligible_tables
from metaloom.operators.view import enriched_view
from metaloom.sources.tables import typed_rows
from tests.fixtures import bag, inventory, metadata, named, tags

seeds = pytest.mark.parametrize("seed", [1, 2, 3])
NAMES = ["a", "b", "c", None]


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def random_inventory(rng, size):
    """Tables with ids from a small pool, each at most once, under random names."""
    ids = {(c, s, t) for c in "cd" for s in "st" for t in "123456"}
    chosen = rng.sample(sorted(ids), size)
    return [(*i, rng.choice("ab"), rng.choice("ab"), rng.choice("ab")) for i in chosen]


def random_tags(rng, size):
    names = [*schemas.TAG_NAMES, "owner"]
    values = ["true", "false", "", "x", "y", None]
    return [
        (rng.choice(NAMES), rng.choice(NAMES), rng.choice(NAMES), rng.choice(names), rng.choice(values))
        for _ in range(size)
    ]


def random_metadata(spark, rng, size):
    return metadata(
        spark,
        *(
            named(i, *(rng.choice(NAMES) for _ in range(3)), **{fv.INTEGRATION: rng.choice(["int", None])})
            for i in range(size)
        ),
    )


@seeds
def test_upsert(spark, seed):
    rng = random.Random(seed)
    known, batch = (
        keyed(inventory(spark, *random_inventory(rng, rng.randint(0, 20)))) for _ in range(2)
    )
    model = {r[fv.RECORD_ID]: r for r in rows_of(known)}
    for row in rows_of(batch):
        if row[fv.RECORD_ID] in model:
            row = model[row[fv.RECORD_ID]] | {c: row[c] for c in schemas.REFRESHED}
        model[row[fv.RECORD_ID]] = row
    expected = sorted(model.values(), key=lambda r: r[fv.RECORD_ID])
    for merge in (upsert_metadata, upsert_small_batch):
        assert sorted(rows_of(merge(known, batch)), key=lambda r: r[fv.RECORD_ID]) == expected


@seeds
def test_status_log(spark, seed):
    rng = random.Random(seed)
    known = random_metadata(spark, rng, 8)
    log = [
        (rng.randrange(10), rng.choice("xy"), "failed", f"m{n}", datetime(2024, 1, 1 + n))
        for n in range(25)
    ]
    rng.shuffle(log)
    model = {r[fv.RECORD_ID]: r for r in rows_of(known)}
    for record, account, status, message, when in sorted(log, key=lambda r: r[4]):
        if record in model:
            model[record] |= {
                fv.ACCOUNT: account,
                fv.SYNC_STATUS: status,
                fv.SYNC_MESSAGE: message,
                fv.SYNC_DATE: when,
            }
    after = rows_of(apply_status(known, typed_rows(spark, log, schemas.STATUS)))
    assert {r[fv.RECORD_ID]: r for r in after} == model and len(after) == len(model)


def tag_model(rows):
    """Tag values by table and tag name; a missing value counts as no value."""
    model = {}
    for *names, tag, value in rows:
        if value is not None and None not in names:
            key = (tuple(names), tag)
            model[key] = max(value, model.get(key, value))
    return model


@seeds
def test_view_and_eligible_tables(spark, seed):
    rng = random.Random(seed)
    known, tag_rows = random_metadata(spark, rng, 40), random_tags(rng, 300)
    model = tag_model(tag_rows)
    view = enriched_view(known, tags(spark, *tag_rows))
    expected = {
        r[fv.RECORD_ID]: [
            model.get((tuple(r[c] for c in schemas.SOURCE_NAMES), tag)) for tag in schemas.TAG_NAMES
        ]
        for r in rows_of(known)
    }
    assert {r[fv.RECORD_ID]: [r[t] for t in schemas.TAG_NAMES] for r in rows_of(view)} == expected
    assert view.count() == 40

    integration = {r[fv.RECORD_ID]: r for r in rows_of(known)}
    ready = {
        i
        for i, (db, sc, tb, flag, _) in expected.items()
        if flag == "true"
        and None not in (db, sc, tb, integration[i][fv.INTEGRATION], integration[i][fv.TABLE_NAME])
    }
    assert {r[fv.RECORD_ID] for r in rows_of(eligible_tables(view))} == ready


@seeds
def test_default_tags(spark, seed):
    rng = random.Random(seed)
    known = metadata(spark, *(named(i, *(rng.choice("abc") for _ in range(3))) for i in range(20)))
    tag_rows = random_tags(rng, 60)
    table = tags(spark, *tag_rows)
    model = tag_model(tag_rows)
    tables = {tuple(r[c] for c in schemas.SOURCE_NAMES) for r in rows_of(known)}
    untagged = {t for t in tables if not any((t, tag) in model for tag in schemas.TAG_NAMES[:4])}
    kept = [r for r in tag_rows if not (r[:3] in untagged and r[3] in schemas.TAG_NAMES)]
    set_rows = [
        (*t, tag, value)
        for t in untagged
        for tag, value in zip(schemas.TAG_NAMES, (*t, "true", ""))
    ]
    new = default_tags(untagged_tables(enriched_view(known, table)))
    assert bag(set_default_tags(table, new)) == bag(tags(spark, *kept, *set_rows))


@seeds
def test_nest_and_flatten(spark, seed):
    rng = random.Random(seed)
    rows = inventory(spark, *random_inventory(rng, 20))
    assert bag(flatten(nest(rows, page_size=rng.choice([1, 3, 50])))) == bag(rows)
