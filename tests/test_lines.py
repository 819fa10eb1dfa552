"""Parsing lines: a line is split once, whatever a job does with its fields."""

from data import BASE, limits_table, lines, tuples
from roadstream.operators.danger import gross_passes
from roadstream.operators.police import slot_rows
from roadstream.operators.speeding import monitor_limits
from roadstream.schemas import TRAFFIC
from roadstream.sources.lines import parse, parse_police, parse_traffic, parse_violation

PASS = f"{BASE},0001,1,C1,99.0,01,01"


def splits(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(")


def test_a_line_is_split_once(spark):
    limits = monitor_limits(limits_table(spark, [("0001", 60)]))
    assert splits(gross_passes(parse_traffic(lines(spark, [PASS])), limits)) == 1
    v, p = lines(spark, [f"C1,speeding,{BASE}"]), lines(spark, [f"J1,C1,done,{BASE}"])
    assert splits(slot_rows(parse_violation(v), parse_police(p))) == 2  # one for each side


def test_every_line_gives_one_row(spark):
    values = [PASS, PASS + ",,,", PASS + ",more", "", ",,,", None, "a,b", PASS.replace("99.0", "x")]
    got = parse(lines(spark, values), TRAFFIC)
    reasons = {r.value: r.reject_reason for r in got.collect()}
    assert got.count() == len(values)
    assert [v for v in values if reasons[v] is None] == values[:3]
    assert tuples(got.where("reject_reason IS NULL"), "car", "speed") == [("C1", 99.0)] * 3
