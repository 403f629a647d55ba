"""Airings from kept state: any order of loads gives the numbers that all history gives."""

import datetime as dt
import random
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from stockout.operators.airings import AiringState
from stockout.operators.report import broadcast_sequence
from stockout.operators.scope import Scope
from stockout.plans.daily import DailyRun
from stockout.sources import from_testdata


def sources(spark, base, shows):
    """shows: (pgm, day, hour, channel, products)."""
    start = lambda d, h: dt.datetime.strptime(d, "%Y%m%d") + dt.timedelta(hours=h)
    broadcast = spark.createDataFrame([(p, start(d, h), d, f"show {p}", c) for p, d, h, c, _ in shows],
                                      "pgm_id long, broad_str_dtm timestamp_ntz, broad_dt string, pgm_nm string, chanl_cd string")
    listed = spark.createDataFrame([(p, x, c) for p, _, _, c, xs in shows for x in xs], "pgm_id long, prd_cd long, chanl_cd string")
    return replace(base, broadcast=broadcast, broadcast_product=listed)


def plain(shows):
    """{(pgm, product, channel): (number, first day)} over all shows."""
    out = {}
    for p, d, h, c, xs in shows:
        for x in xs:
            at = lambda s: (dt.datetime.strptime(s[1], "%Y%m%d") + dt.timedelta(hours=s[2]))
            mine = [s for s in shows if x in s[4] and s[3] == c]
            earlier = {at(s) for s in mine if at(s) <= at((p, d, h))}
            out[p, x, c] = (len(earlier), min(s[1] for s in shows if x in s[4]))
    return out


DAYS = ["20160801", "20160802", "20160803"]


@pytest.fixture(scope="module")
def base(spark):
    return from_testdata(spark, SMOKE_DIR)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_loads(spark, base, seed):
    rng = random.Random(seed)
    shows = [(k, rng.choice(DAYS), rng.choice([1, 9, 20, 23, 26, 33]), rng.choice("CH"), sorted({rng.randrange(4) for _ in range(2)}))
             for k in range(14)]
    changed = [s for s in shows if s[0] % 5]  # some shows are cancelled later
    state = AiringState(spark, tempfile.mkdtemp(prefix="stockout-airings-"))
    order = rng.sample(DAYS, 3)
    found, now = {}, None
    for day, content in [*((d, shows) for d in order), (order[0], changed), (order[1], changed)]:
        now = sources(spark, base, content)
        done = state.load(now, day)
        found[day] = {tuple(r) for r in done.numbered.select("pgm_id", "prd_cd", "chanl_cd", "broad_seq", "first_dt").collect()}
        loaded = set(found)
        for other in loaded - {day}:
            fresh = {tuple(r) for r in state.number(sources(spark, base, [s for s in shows if s[1] == other and (s in changed or other != order[0] or content is shows)]), other)
                     .select("pgm_id", "prd_cd", "chanl_cd", "broad_seq", "first_dt").collect()}
            assert (fresh != found[other]) <= (other in done.renumbered)  # no change goes unnamed
            found[other] = fresh
    left = [s for s in shows if s in changed or s[1] == order[2]]
    want = {(*k, *v) for k, v in plain(left).items()}
    assert set().union(*found.values()) == want


def test_a_day_behind_all_others_reads_no_history(spark, base):
    state = AiringState(spark, tempfile.mkdtemp(prefix="stockout-airings-"))
    shows = [(1, DAYS[0], 9, "C", [1, 2]), (2, DAYS[1], 9, "C", [1]), (3, DAYS[2], 9, "C", [1, 3]), (4, DAYS[2], 20, "C", [1])]
    src = sources(spark, base, shows)
    loads = [state.load(src, d) for d in DAYS]
    assert [x.read_history for x in loads] == [False] * 3 and [x.renumbered for x in loads] == [()] * 3
    files = loads[2].numbered.inputFiles()
    starts = {f.split("/starts/")[1].split("/")[0] for f in files if "/starts/" in f}
    assert len(starts) == 1 and state.days() == DAYS
    assert {(r["pgm_id"], r["prd_cd"]): r["broad_seq"] for r in loads[2].numbered.collect()} == {(3, 1): 3, (3, 3): 1, (4, 1): 4}
    again = state.load(src, DAYS[1])  # nothing changed: read, but nobody renumbered
    assert again.read_history and again.renumbered == ()
    gone = state.load(sources(spark, base, [s for s in shows if s[0] != 2]), DAYS[1])
    assert gone.renumbered == (DAYS[2],) and gone.numbered.count() == 0


def test_a_load_that_breaks_leaves_the_state(spark, base, monkeypatch):
    from stockout.operators import airings

    state = AiringState(spark, tempfile.mkdtemp(prefix="stockout-airings-"))
    src = sources(spark, base, [(1, DAYS[0], 9, "C", [1]), (2, DAYS[1], 9, "C", [1])])
    state.load(src, DAYS[0])
    with monkeypatch.context() as m:
        m.setattr(airings, "write_note", lambda *a: (_ for _ in ()).throw(OSError("injected")))
        with pytest.raises(OSError):
            state.load(src, DAYS[1])
    assert state.days() == DAYS[:1]
    assert [r["broad_seq"] for r in state.load(src, DAYS[1]).numbered.collect()] == [2]


def test_a_run_takes_its_numbers_from_the_state(spark, base):
    state = AiringState(spark, tempfile.mkdtemp(prefix="stockout-airings-"))
    for day in ("19960101", "19980101"):
        numbered = state.load(base, day).numbered
    early = replace(base, broadcast=base.broadcast.where("broad_dt in ('19960101', '19980101')"))
    scope = Scope(days=("19980101",))
    run = DailyRun(base, scope, numbered=numbered)
    assert sorted(run.pgm.collect()) == sorted(broadcast_sequence(early, scope).collect())
    assert run.pgm.where(F.col("broad_seq") > 1).count() > 0
