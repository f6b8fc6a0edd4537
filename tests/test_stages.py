"""Runs that stop, go on and start anew."""

import json

import pytest

from tidemark.plans.stages import LEDGER, Stage, check_plan, run_stages


def plan(ran, least=1, fails=()):
    def kept(spark, ids, least):
        ran.append("kept")
        return ids.filter(f"id >= {least}")

    def doubled(spark, kept):
        ran.append("doubled")
        if "doubled" in fails:
            raise RuntimeError("no luck")
        return kept.selectExpr("2 * id AS id")

    return [Stage("kept", kept, ("ids",), {"least": least}), Stage("doubled", doubled, ("kept",))]


def test_failure_keeps_the_prefix_and_changes_start_anew(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "ids"))
    inputs, folder, ran = {"ids": str(tmp_path / "ids")}, str(tmp_path / "run"), []
    with pytest.raises(RuntimeError):
        run_stages(spark, plan(ran, fails=["doubled"]), inputs, folder)
    ledger = json.loads((tmp_path / "run" / LEDGER).read_text())
    assert [ledger[n]["status"] for n in ("kept", "doubled")] == ["done", "failed"] and ledger["kept"]["rows"] == 3
    out = run_stages(spark, plan(ran), inputs, folder)
    assert sorted(r.id for r in out["doubled"].collect()) == [2, 4, 6] and ran == ["kept", "doubled", "doubled"]
    run_stages(spark, plan(ran), inputs, folder)
    assert len(ran) == 3
    out = run_stages(spark, plan(ran, least=3), inputs, folder)
    assert [r.id for r in out["doubled"].collect()] == [6] and len(ran) == 5
    run_stages(spark, plan(ran, least=3), inputs, folder, resume=False)
    assert len(ran) == 7


def test_changed_code_and_a_broken_off_ledger(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "ids"))
    inputs, folder, ran = {"ids": str(tmp_path / "ids")}, tmp_path / "run", []
    run_stages(spark, plan(ran), inputs, str(folder))
    (folder / LEDGER).rename(folder / f"new_{LEDGER}")
    run_stages(spark, plan(ran), inputs, str(folder))
    assert len(ran) == 2
    changed = plan(ran)[:1] + [Stage("doubled", lambda spark, kept: kept.selectExpr("3 * id AS id"), ("kept",))]
    out = run_stages(spark, changed, inputs, str(folder))
    assert sorted(r.id for r in out["doubled"].collect()) == [3, 6, 9] and len(ran) == 2
    again = plan(ran)[:1] + [Stage("doubled", lambda spark, kept: kept.selectExpr("4 * id AS id"), ("kept",))]
    assert sorted(r.id for r in run_stages(spark, again, inputs, str(folder))["doubled"].collect()) == [4, 8, 12]


def test_plans_that_cannot_run_are_refused():
    with pytest.raises(ValueError, match="needs kept"):
        check_plan(plan([])[::-1], {"ids": ""})
    with pytest.raises(ValueError, match="two tables"):
        check_plan(plan([]), {"ids": "", "kept": ""})
