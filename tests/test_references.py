"""Orphan references against a brute-force version, with hot ids, ties and nulls."""

import random
from datetime import datetime, timedelta

from lexframe.operators import references as R

T0 = datetime(2024, 1, 1)
REFS = "table_name string, row_id bigint, ref_id string, ts timestamp_ntz"
EVENTS = "ref_id string, ts timestamp_ntz"


def brute(refs, records, removals):
    out = []
    for name, row, key, ts in refs:
        if key is None:
            continue
        at = ts or datetime.max
        mine = [t or datetime.max for k, t in records if k == key]
        seen = [t for t in mine if t <= at]
        kind = None
        if not mine:
            kind = "missing"
        elif not seen:
            kind = "late"
        elif any(k == key and t is not None and max(seen) < t <= at for k, t in removals):
            kind = "deleted"
        if kind:
            out.append((name, row, key, kind, ts and ts.strftime("%Y-%m")))
    return sorted(out, key=str)


def test_kinds_against_brute_force(spark):
    rnd = random.Random(5)
    when = lambda: rnd.choice([None] + [T0 + timedelta(hours=rnd.randint(0, 90)) for _ in range(30)])
    key = lambda: rnd.choice(["hot"] * 10 + list("abcdefgh") + [None])
    refs = [(rnd.choice("xy"), i // 2, key(), when()) for i in range(600)]
    records = [(key(), when()) for _ in range(40)]
    removals = [(key(), when()) for _ in range(40)]
    got = R.orphan_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(records, EVENTS), spark.createDataFrame(removals, EVENTS))
    assert sorted(map(tuple, got.collect()), key=str) == brute(refs, records, removals)


def test_removal_at_the_instant_of_a_record_does_not_outlast_it(spark):
    refs = spark.createDataFrame([("t", 1, "a", T0)], REFS)
    both = spark.createDataFrame([("a", T0)], EVENTS)
    assert R.orphan_references(refs, both, both).count() == 0


def test_empty_tables(spark):
    refs, none = spark.createDataFrame([], REFS), spark.createDataFrame([], EVENTS)
    assert R.orphan_references(refs, none, none).count() == 0
    one = spark.createDataFrame([("t", 1, "a", None)], REFS)
    assert [tuple(r) for r in R.orphan_references(one, none, none).collect()] == [("t", 1, "a", "missing", None)]


def test_counts_from_batches_equal_the_whole(spark):
    rnd = random.Random(7)
    keys = ["hot"] * 8 + list("abcdefghij")
    changes = [(rnd.choice(keys), rnd.choice(["reference"] * 3 + ["withdrawn", "record", "record", "removal", "removal"]), T0 + timedelta(hours=rnd.randint(0, 60))) for _ in range(300)]
    ids = {k for k, _, _ in changes}
    expected = {}
    for k in ids:
        mine = [(t, c == "record") for x, c, t in changes if x == k and c in ("record", "removal")]
        refs = sum({"reference": 1, "withdrawn": -1}.get(c, 0) for x, c, _ in changes if x == k)
        expected[k] = (refs, int(max(mine)[1]) if mine else 0)
    log = "ref_id string, change string, ts timestamp_ntz"
    for cut in range(3):  # all at once, in the order of time, and at random
        parts = [changes] if not cut else [[c for i, c in enumerate(changes) if (c[2].day % 3 if cut == 1 else i % 4) == n] for n in range(4)]
        counts = None
        for part in parts:
            counts = R.merge_counts(counts, R.count_deltas(spark.createDataFrame(part, log), counts))
        got = {r.ref_id: (r.n_ref, r.n_exist) for r in counts.collect()}
        assert {k: v for k, v in got.items() if v != (0, 0)} == {k: v for k, v in expected.items() if v != (0, 0)}
        assert {tuple(r) for r in R.current_orphans(counts).collect()} == {(k, n) for k, (n, e) in expected.items() if n > 0 and not e}


def test_a_removal_in_a_later_batch(spark):
    log = "ref_id string, change string, ts timestamp_ntz"
    day = lambda n: T0 + timedelta(n)
    counts = None
    seen = []
    for batch in ([("a", "record", day(0)), ("a", "reference", day(0))], [("a", "record", day(2))], [("a", "removal", day(1))], [("a", "removal", day(3))], [("a", "withdrawn", day(4))], [("a", "record", day(5))]):
        counts = R.merge_counts(counts, R.count_deltas(spark.createDataFrame(batch, log), counts))
        seen.append((*counts.select("n_ref", "n_exist").first(), R.current_orphans(counts).count()))
    assert seen == [(1, 1, 0), (1, 1, 0), (1, 1, 0), (1, 0, 1), (0, 0, 0), (0, 1, 0)]


def test_ids_of_addresses(spark):
    df = spark.sql("""select * from values ('https://x/van-ban/chi-tiet/88B26A47-3EBB-4D13-B266-1C9CD7FEF8BC'), ('https://x/cu--20000206/'), ('https://x/none'), (null) as t(u)""")
    assert [r[0] for r in df.select(R.id_of_url(df.u)).collect()] == ["88b26a47-3ebb-4d13-b266-1c9cd7fef8bc", "20000206", None, None]
