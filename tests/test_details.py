"""Details of cards against a plain loop, and cache files."""

import random

import pytest

from entityspark.operators import details, signals
from entityspark.sources import readers


def asked_one_by_one(cards, answers, most):
    cache, out, seen, reason = {}, {}, [], ""
    for k, org in cards:
        if org in cache:
            out[k] = cache[org]
            continue
        if reason or most and len(seen) >= most:
            out[k] = ("circuit_open" if reason else "detail_budget_exhausted", "0.50", "contact_unverified|manual_review", "")
            reason = reason or "budget"
            continue
        status, phone = answers.get(org, (None, ""))
        own = status if status in details.QUALITY else "navigation_error"
        confidence, flags = details.QUALITY[own]
        cache[org] = out[k] = (own, confidence, "|".join([*flags.split(), *([] if status else ["detail_exception"])]), phone)
        seen.append(own)
        recent, row = seen[-20:], 0
        for s in seen:
            row = 0 if s in ("ok", "empty") else row + 1
        failed = sum(s in signals.FAILURES for s in recent)
        if own in signals.WALLS or row >= 6 or len(recent) >= 10 and (failed >= 0.5 * len(recent) or recent.count("empty") >= 0.8 * len(recent)):
            reason = own
    return out


@pytest.mark.parametrize("seed,most", [(1, 15), (2, 0), (3, 400), (4, 0)])
def test_details_match_a_loop(spark, seed, most):
    rnd = random.Random(seed)
    kinds = ["ok"] * 12 + ["empty"] * 3 + ["timeout", "strange", None] + (["captcha"] if seed == 4 else [])
    answers = {o: (rnd.choice(kinds), f"8 978 {o:07d}") for o in range(60)}
    cards = [(k, rnd.randrange(70) if rnd.random() < 0.9 else 5) for k in range(260)]
    asked = [(o, s, p, None, "") for o, (s, p) in answers.items()]
    found = details.detailed(spark.createDataFrame(cards, "k long, org_id long").repartition(3), spark.createDataFrame(asked, "org_id long, status string, phone string, email string, website string"), ["k"], most)
    assert {r["k"]: (r["status"], r["confidence"], r["flags"], r["phone"]) for r in found.collect()} == asked_one_by_one(cards, answers, most)


def test_cache_files_are_read_as_far_as_they_can_be(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a.ru": {"checked_at": "2026-01-01T00:00:00+00:00", "status": "found", "via": "static", "contacts": {"email": "x@a.ru"}}, "b.ru": {"status": "odd"}, "c.ru": 5, "d.ru": {"status": "dead", "contacts": 7}, "e.ru": "{x"}')
    (tmp_path / "bad.json").write_text("{not json")
    (tmp_path / "list.json").write_text("[1]")
    rows = {r["host"]: r for r in readers.cache_file(spark, str(tmp_path), ["found", "none", "dead"]).collect()}
    assert set(rows) == {"a.ru", "d.ru"} and rows["a.ru"]["contacts"] == {"email": "x@a.ru"} and rows["a.ru"]["via"] == "static"
    assert readers.cache_file(spark, str(tmp_path / "none.json")).collect() == []
