"""D8 and D10 against direct Python evaluation of their definitions.

Random histories include a hot customer holding a large share of all rows,
repeated timestamps, missing devices and repeated loan numbers.
"""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from pitwise import operators as op
from tests.conftest import frame
from tests.test_quirks import EVENTS, LOANS, OVERDUE, REPAY

BASE = datetime(2020, 1, 1)
CENSOR = datetime(2022, 1, 1)


def _burst_reference(rows, devices=4, days=7):
    """The definition: some event time t with >= 4 devices seen in [t-7d, t]."""
    per = defaultdict(list)
    for c, t, d in rows:
        if t is not None and t < CENSOR:
            per[c].append((t, d if d is not None else "unknown"))
    out = {}
    for c, ev in per.items():
        flag = 0.0
        for t, _ in ev:
            seen = {d for u, d in ev if t - timedelta(days=days) <= u <= t}
            if len(seen) >= devices:
                flag = 1.0
                break
        out[c] = flag
    return out


def test_device_burst_matches_definition(spark):
    rnd = random.Random(7)
    rows = []
    for c in range(40):
        n = 400 if c == 0 else rnd.randint(1, 25)  # customer 0 is hot
        span = rnd.choice([5, 20, 200])
        for _ in range(n):
            t = BASE + timedelta(days=rnd.uniform(0, span), seconds=rnd.choice([0, 0, 1]))
            t = t.replace(microsecond=0) if rnd.random() < 0.5 else t
            dev = None if rnd.random() < 0.1 else f"d{rnd.randint(0, 6)}"
            rows.append((f"c{c}", t, dev))
    df = frame(spark, EVENTS, [(c, "acc", CENSOR, t, "E", d) for c, t, d in rows])
    got = {r.cust_ids: r["7days_device_cnt_more_than4"] for r in op.device_burst_7d(df).collect()}
    assert got == _burst_reference(rows)
    assert 0 < sum(got.values()) < len(got)


def _history_reference(loans, od_day, paid):
    """Sum over pairs (loan, earlier loan of the customer, other loan number)."""
    by_c = defaultdict(list)
    for no, c, t, x in loans:
        by_c[c].append((no, t, x))
    out = {}
    for c, ls in by_c.items():
        acc = [0.0] * 5
        pairs = 0
        for no0, t0, _ in ls:
            for no1, t1, x1 in ls:
                if no1 == no0 or not t1 < t0:
                    continue
                pairs += 1
                od, pt = od_day.get(no1), paid.get(no1)
                good = pt is not None and pt < t0 and (od is None or od > t0.date())
                bad = od is not None and od <= t0.date()
                acc[0] += good
                acc[1] += bad
                acc[2] += good and x1
                acc[3] += bad and x1
        if pairs:
            out[c] = tuple(float(v) for v in acc[:4])
    return out


@pytest.mark.parametrize("bucket_days", [1, 15])
def test_loan_history_matches_pairwise_definition(spark, bucket_days):
    rnd = random.Random(11)
    loans, od_rows, pay_rows = [], [], []
    k = 0
    for c in range(30):
        n = 120 if c == 0 else rnd.randint(1, 8)  # customer 0 is hot
        for _ in range(n):
            k += 1
            no = f"L{k}" if rnd.random() > 0.05 else f"L{max(1, k - 1)}"  # some repeated numbers
            t = BASE + timedelta(days=rnd.randint(0, 700), hours=rnd.choice([0, 0, 9]))
            loans.append((no, f"c{c}", t, rnd.random() < 0.4))
            if rnd.random() < 0.5:
                od_rows.append((no, t + timedelta(days=rnd.randint(-5, 90))))
            if rnd.random() < 0.6:
                pay_rows.append((no, t + timedelta(days=rnd.randint(1, 60), seconds=rnd.randint(0, 86399))))
    od_day, paid = {}, {}
    for no, d in od_rows:
        od_day[no] = min(od_day.get(no, d.date()), d.date())
    for no, p in pay_rows:
        paid[no] = min(paid.get(no, p), p)
    codes = lambda x: ("10", "RXD", "02") if x else ("20", "CASH", "02")
    ldf = frame(spark, LOANS, [(no, c, t, Decimal("1.00"), 3.0, 0.1, *codes(x)) for no, c, t, x in loans])
    odf = frame(spark, OVERDUE, [(no, d, d.date(), 1.0) for no, d in od_rows])
    pdf = frame(spark, REPAY, [(no, None, None, "200", p, None) for no, p in pay_rows])
    got = {
        r.cust_ids: (r.all_good_cnt, r.all_bad_cnt, r.xfd_good_cnt, r.xfd_bad_cnt)
        for r in op.loan_history_counts(op.loan_outcomes(ldf, odf, pdf), bucket_days=bucket_days).collect()
    }
    assert got == _history_reference([(no, c, t, x) for no, c, t, x in loans], od_day, paid)
