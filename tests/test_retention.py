"""Versions that stay and versions that go."""

from __future__ import annotations

import os

import pytest
from samples import raw_frame

from casestar.__main__ import main
from casestar.operators.quality import GateFailure
from casestar.plans import etl
from casestar.plans.etl import build_warehouse, publish_star, stage_star
from casestar.sources.retention import sweep, take_lease
from casestar.sources.warehouse import open_warehouse


def versions(path):
    return {p.name for p in path.iterdir() if p.name.startswith("v-")}


def named(warehouse):
    return warehouse.path.rsplit("/", 1)[-1]


def test_refused_and_superseded_versions_go_a_running_build_stays(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    old = build_warehouse(spark, raw_frame(spark, {}), root)
    now = build_warehouse(spark, raw_frame(spark, {}, {}), root)
    # refused before the dimensions, and refused by the gate at the end
    with pytest.raises(GateFailure):
        build_warehouse(spark, raw_frame(spark, {"collision_id": "x"}), root)
    with monkeypatch.context() as patch:
        patch.setattr(etl, "check_ids", lambda clean: None)
        with pytest.raises(GateFailure):
            build_warehouse(spark, raw_frame(spark, {"collision_id": "x"}), root)
    refused = [p for p in tmp_path.glob("v-*/audit") if p.parent.name not in (
        named(old), named(now))]
    assert len(refused) == 1  # the second one left its figures
    assert not list((tmp_path / "_building").glob("v-*"))
    running = stage_star(raw_frame(spark, {}, {}, {}), root)

    would_go = sweep(spark, root, dry_run=True)
    assert len(versions(tmp_path)) == 5
    assert sweep(spark, root) == would_go
    assert sorted(item.reason for item in would_go) == [
        "never published", "never published", "staging of a published version", "superseded"]
    assert versions(tmp_path) == {named(now), running.path.rsplit("/", 1)[-1]}
    assert not os.path.exists(f"{now.path}/_stage")
    assert open_warehouse(spark, root).table("fact_crash").count() == 2
    # the running build is whole and becomes the readable one
    publish_star(running, root)
    assert open_warehouse(spark, root).table("fact_crash").count() == 3
    assert not list((tmp_path / "_building").glob("v-*"))
    main(["--master", "local[8]", "sweep", root, "--keep", "2"])
    assert versions(tmp_path) == {named(now), running.path.rsplit("/", 1)[-1]}
    assert not os.path.exists(f"{running.path}/_stage")


def test_a_lease_of_a_dead_build_runs_out(spark, tmp_path):
    root = str(tmp_path)
    dead = stage_star(raw_frame(spark, {}), root).path
    assert sweep(spark, root) == []
    reasons = {item.reason for item in sweep(spark, root, lease_hours=0)}
    assert reasons == {"never published", "lease has run out"}
    assert not os.path.exists(dead)


def test_nothing_to_sweep_and_no_zero_kept(spark, tmp_path):
    assert sweep(spark, str(tmp_path / "none")) == []
    take_lease(spark, str(tmp_path / "fresh"), "v-1")
    assert sweep(spark, str(tmp_path / "fresh")) == []
    with pytest.raises(ValueError, match="keep"):
        sweep(spark, str(tmp_path), keep=0)
