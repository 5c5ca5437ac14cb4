"""Requests, deletions and expiries of one log against a loop over its rows."""

import random
from datetime import datetime, timedelta

import pytest

from proofmark import values as v
from proofmark.operators import starts as S

T0 = datetime(2024, 1, 1)
REQUEST = "request_id long, application_id long, user_id string, form_no string, at timestamp, force boolean, delete_at timestamp, note string"


def at(n):
    return None if n is None else T0 + timedelta(seconds=n)


def loop(requests, apps, ends):
    """Row after row, with the list of living applications of each user and form."""
    lives, answers, seen, known = {}, {}, set(), {a[0] for a in apps}
    stops = {}
    for i, t in ends:
        stops.setdefault(i, []).append(t)
    for i, user, form, status, limit in apps:
        if status in (v.CREATED, v.COMPLETED):
            end = min([t for t in stops.get(i, []) + [limit] if t is not None], default=10**9)
            lives.setdefault((user, form), []).append(end)
    for r, i, user, form, t, force, limit, _ in sorted(requests, key=lambda x: (x[4] is not None, x[4] or 0, x[0])):
        if i in known:
            answers[r] = "application exists"
        elif i in seen:
            answers[r] = "created twice"
        else:
            seen.add(i)
            if user is None or form is None or t is None:
                answers[r] = None
                continue
            alive = any(end > t for end in lives.get((user, form), []))
            answers[r] = v.ALREADY_EXISTS if alive and not force else None
            if answers[r] is None:
                end = min([x for x in stops.get(i, []) if x >= t] + ([limit] if limit is not None else []), default=10**9)
                lives.setdefault((user, form), []).append(max(end, t))
    return answers


def tables(spark, requests, apps, ends):
    r = [(*x[:4], at(x[4]), x[5], at(x[6]), x[7]) for x in requests]
    a = [(*x[:4], at(x[4])) for x in apps]
    return (
        spark.createDataFrame(r, REQUEST),
        spark.createDataFrame(a, "application_id long, user_id string, form_no string, status string, delete_at timestamp"),
        spark.createDataFrame([(i, at(t)) for i, t in ends], "application_id long, at timestamp"),
    )


@pytest.mark.parametrize("seed,users,span,n", [(1, 3, 40, 300), (2, 1, 2000, 400), (3, 1, 15, 200), (4, 40, 5000, 300)])
def test_fold_equals_loop(spark, seed, users, span, n):
    rnd = random.Random(seed)
    some = lambda: rnd.choice([None, rnd.randint(0, span)])
    requests = [
        (k, 1000 + (k if rnd.random() < 0.95 else rnd.randint(0, n)), rnd.choice([f"u{rnd.randrange(users)}"] * 20 + [None]), "f",
         rnd.randint(0, span), rnd.choice([True, False, False, False, None]), some(), "x")
        for k in range(n)
    ]
    requests += [(n, 5000, "u0", None, 3, False, None, "x"), (n + 1, 5001, "u0", "f", None, False, None, "x")]
    apps = [(k, f"u{k % 4}", rnd.choice(["f", "g"]), rnd.choice([v.CREATED, v.SUBMITTED]), rnd.randint(0, span // 3)) for k in range(4)]
    apps.append((1003, "u9", "f", v.SUBMITTED, None))
    ends = [(1000 + rnd.randrange(n), rnd.randint(0, span)) for _ in range(n)] + [(k, rnd.randint(0, span // 3)) for k in range(3)]
    new, existing = S.fold_starts(*tables(spark, requests, apps, ends), slot_us=7_000_000)
    got = {r.request_id: None for r in new.collect()} | {r.request_id: r.answer for r in existing.collect()}
    assert got == loop(requests, apps, ends)
    assert len(set(got.values())) > 2 and new.columns == [c.split()[0] for c in REQUEST.split(", ")]


def test_a_long_chain_of_one_user(spark):
    """Each application is deleted just as the request after the next comes: every other one is accepted."""
    n = 2000
    requests = [(k, k, "u", "f", k, False, None, "x") for k in range(n)]
    new, existing = S.fold_starts(*tables(spark, requests, [], [(k, k + 2) for k in range(n)]))
    assert sorted(r.request_id for r in new.collect()) == list(range(0, n, 2))
    assert existing.count() == n // 2


def test_starts_as_changes(spark):
    requests = [(1, 10, "u", "f", 5, False, None, "x"), (2, 11, "u", "f", 6, None, None, "x"), (3, 12, "u", "f", 7, True, None, "x"), (4, 10, "u", "g", 8, True, None, "x")]
    rows, apps, ends = tables(spark, requests, [], [(10, 20)])
    changes = rows.selectExpr("request_id AS change_id", "'create' AS op", "* EXCEPT (request_id)")
    state, refused = S.apply_starts(changes, apps, ends)
    assert sorted((r.application_id, r.status) for r in state.collect()) == [(10, v.CREATED), (12, v.CREATED)]
    assert sorted((r.change_id, r.reason) for r in refused.collect()) == [(2, v.ALREADY_EXISTS), (4, "created twice")]


def test_empty_log(spark):
    new, existing = S.fold_starts(*tables(spark, [], [], []))
    assert new.count() == existing.count() == 0
