"""Overlaps, dated hierarchies, allocation and near duplicates against plain versions."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest

from verisift.operators import allocation, duplicates, hierarchy, overlap

DAY = date(2020, 1, 1)


def day(n):
    return None if n is None else DAY + timedelta(days=int(n))


def test_overlap_equals_pairs(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(160):
        begin = int(rng.integers(0, 60))
        end = None if i % 9 == 0 else begin + int(rng.integers(-2, 30))
        rows.append((f"K{i // 2 if i % 7 == 0 else i}", f"C{i % 4}", f"P{i % 3}", day(begin), day(end)))
    rows += [(None, "C0", "P0", day(1), day(5)), ("K1", None, "P0", day(1), day(5)), ("K2", "C0", "P0", None, day(5))] + [rows[3]] * 3
    df = spark.createDataFrame(rows, "contract_id string, customer_id string, product_id string, effective_date date, expiration_date date")
    low, high = day(10), day(50)
    used = [
        (k, c, p, max(x, low), min(y or high, high))
        for k, c, p, x, y in rows
        if None not in (k, c, p, x) and (y is None or y >= x)
    ]
    used = [r for r in used if r[3] <= r[4]]
    pairs, days, most = Counter(), Counter(), Counter()
    for i, a in enumerate(used):
        for b in used[i + 1 :]:
            common = (min(a[4], b[4]) - max(a[3], b[3])).days + 1
            if a[1:3] == b[1:3] and a[0] != b[0] and common > 0:
                pairs[a[1]] += 1
                days[a[1]] += common
        at_once = sum(b[1:3] == a[1:3] and b[3] <= a[3] <= b[4] for b in used)
        most[a[1]] = max(most[a[1]], at_once)
    found = overlap.contract_overlap_between(df, low, high).collect()
    assert {r["customer_id"]: tuple(r)[1:] for r in found} == {c: (pairs[c], days[c], most[c]) for c in pairs}
    assert overlap.contract_overlap_between(df.limit(0), low, high).isEmpty()


def _ways(links):
    steps = {(c, p, f or date.min, t or date.max) for c, p, f, t in links if c and p and c != p and (f or date.min) <= (t or date.max)}
    found, newest, level = {s: 1 for s in steps}, steps, 1
    while newest:
        level += 1
        longer = {
            (m, p, max(f, f2), min(t, t2))
            for m, a, f, t in newest
            for c, p, f2, t2 in steps
            if a == c and m != p and max(f, f2) <= min(t, t2)
        }
        newest = longer - set(found)
        found.update({s: level for s in newest})
    return found


def test_hierarchy_equals_walking_up(spark):
    rng = np.random.default_rng(4)
    links = [(f"n{rng.integers(0, 14)}", f"n{rng.integers(0, 14)}", day(b), day(b + int(rng.integers(-3, 40)))) for b in rng.integers(0, 60, 30)]
    links += [("a", "b", None, None), ("b", "a", None, day(9)), ("b", "c", day(3), None), ("x", "a", None, None), (None, "a", None, None), ("a", None, None, None)]
    links += [links[0], links[0]]
    closure = hierarchy.dated_closure(spark.createDataFrame(links, "child string, parent string, valid_from date, valid_to date"))
    expected = _ways(links)
    got = {tuple(r)[:4]: r["level"] for r in closure.collect()}
    assert got == expected
    on = {}
    for (m, a, f, t), level in expected.items():
        if f <= day(20) <= t:
            on[m, a] = min(level, on.get((m, a), 99))
    assert {(r["member"], r["ancestor"]): r["level"] for r in hierarchy.hierarchy_as_of(closure, day(20)).collect()} == on
    facts = [("x", day(5), 10), ("x", day(15), 7), ("x", day(15), 1), ("zz", day(5), 3), (None, day(5), 3), ("x", None, 3)]
    frame = spark.createDataFrame(facts, "who string, at date, amount long")
    rolled = hierarchy.rolled_up(frame, closure, member="who", at="at", value="amount")
    assert sorted(map(tuple, rolled.collect())) == [("a", 1, 18, 3, 1), ("b", 2, 18, 3, 1), ("c", 3, 18, 3, 1)]
    empty = spark.createDataFrame([], "child string, parent string, valid_from date, valid_to date")
    assert hierarchy.dated_closure(empty).isEmpty()


def _fifo(claims, sales):
    """Units one by one, oldest first."""
    out = Counter()
    for key in {c[1] for c in claims}:
        stock = [[d, i, q] for i, k, d, q in sorted((s for s in sales if s[1] == key), key=lambda s: (s[2], s[0]))]
        for claim, _, on, wanted in sorted((c for c in claims if c[1] == key), key=lambda c: (c[2], c[0])):
            for item in stock:
                taken = min(wanted, item[2]) if item[0] <= on else 0
                if taken > 0:
                    out[key, claim, item[1]] += taken
                    wanted, item[2] = wanted - taken, item[2] - taken
    return out


@pytest.mark.parametrize("cell_rows", [100_000, 3])
def test_allocation_equals_taking_units(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(allocation, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(cell_rows)

    def rows(n, name, most):
        return [
            (f"{name}{i:03}", f"k{rng.integers(0, 4)}", day(rng.integers(0, 25)), Decimal(int(rng.integers(1, most))) / 4)
            for i in range(n)
        ]

    sales, claims = rows(90, "S", 40), rows(80, "C", 60)
    claims += [("C900", "k9", day(3), Decimal(5))]
    kind = "id string, key string, day date, quantity decimal(18,4)"
    names = {"claim_id": "id", "claim_day": "day", "sale_id": "sale", "sale_day": "day"}
    extra = [("C901", None, day(1), Decimal(1)), ("C902", "k1", None, Decimal(1)), ("C903", "k1", day(1), Decimal(0)), ("C904", "k1", day(1), None)]
    asked = spark.createDataFrame(claims + extra, kind)
    sold = spark.createDataFrame(sales + [(None, "k1", day(0), Decimal(99))], kind).withColumnRenamed("id", "sale")
    found = allocation.allocate_claims(asked, sold, ["key"], **names)
    assert {(r["key"], r["id"], r["sale"]): r["allocated"] for r in found.collect()} == dict(_fifo(claims, sales))
    given = defaultdict(Decimal)
    for (_, claim, _), q in _fifo(claims, sales).items():
        given[claim] += q
    state = allocation.claim_allocation(asked, found, ["key"], claim_id="id")
    for r in state.where("id <> 'C902'").collect():
        assert r["allocated"] == given[r["id"]] and r["allocated"] + r["open_quantity"] == r["quantity"]
    assert allocation.allocate_claims(asked.limit(0), sold, ["key"], **names).isEmpty()
    assert allocation.allocate_claims(asked, sold.limit(0), ["key"], **names).isEmpty()


def test_rows_of_small_keys_are_moved_once_for_the_allocation(spark):
    kind = "customer_id string, product_id string, id string, day date, quantity decimal(18,4)"
    frame = spark.createDataFrame([("c", "p", "a", day(1), Decimal(2))], kind)
    sales = frame.withColumnsRenamed({"id": "transaction_id", "day": "transaction_date"})
    found = allocation.allocate_claims(frame.withColumnsRenamed({"id": "claim_id", "day": "claim_date"}), sales)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert [tuple(r) for r in found.collect()] == [("c", "p", "a", "a", Decimal(2))]


def test_days_in_reach_are_not_listed_one_by_one(spark):
    df = spark.createDataFrame([(i, "b", day(40 * i), 1.0) for i in range(20)], "id long, who string, at date, amount double")
    found = duplicates.with_duplicate_closeness(df, ["who"], "at", "amount", max_days=30)
    assert "date_sub(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r["feat_duplicate_closeness"] for r in found.collect()} == {0.0}


@pytest.mark.parametrize("days", [0, 1, 40])
def test_closeness_across_the_edges_of_spans(spark, days):
    start = date(1969, 12, 1)
    rows = [(i, "b", start + timedelta(days=int(i)), 1.0) for i in np.random.default_rng(days).choice(400, 60, replace=False)]
    df = spark.createDataFrame([(int(i), w, d, a) for i, w, d, a in rows], "id long, who string, at date, amount double")
    found = duplicates.with_duplicate_closeness(df, ["who"], "at", "amount", max_days=days)
    for r in found.collect():
        gap = min(abs((r["at"] - d).days) for i, _, d, _ in rows if i != r["id"])
        assert r["feat_duplicate_closeness"] == round(max(0.0, 1 - gap / (days + 1)), 4)


def test_closeness_equals_pairs(spark):
    rng = np.random.default_rng(6)
    rows = [
        (i, None if i % 19 == 0 else f"b{i % 3}", None if i % 23 == 0 else day(rng.integers(0, 50)), None if i % 29 == 0 else float(rng.integers(-400, 400)) / 100)
        for i in range(220)
    ]
    rows += [(500, "b0", rows[1][2], rows[1][3]), (501, "b0", rows[3][2], rows[3][3])] + [(600, "solo", day(1), 1.0)]
    df = spark.createDataFrame(rows, "id long, who string, at date, amount double")
    days, amount = 3, 0.25
    expected = {}
    for i, b, d, a in rows:
        best = 0.0
        for j, c, e, o in rows:
            if i != j and b == c and None not in (d, e, a, o) and abs((d - e).days) <= days and abs(round(a * 100) - round(o * 100)) <= 25:
                best = max(best, (1 - abs((d - e).days) / (days + 1)) * (1 - round(abs(a - o), 4) / (amount + 0.0001)))
        expected[i] = round(best, 4)
    found = duplicates.with_duplicate_closeness(df, ["who"], "at", "amount", max_days=days, max_amount=amount)
    assert found.columns == [*df.columns, "feat_duplicate_closeness"]
    got = {r["id"]: r["feat_duplicate_closeness"] for r in found.collect()}
    assert got.keys() == expected.keys()
    assert all(abs(got[i] - expected[i]) < 1.1e-4 for i in got)
    assert duplicates.with_duplicate_closeness(df.limit(0), ["who"], "at", "amount").isEmpty()
