"""Every gold query streams what its inputs hold now."""

from chalkline.plans import catalog


def test_a_rerun_streams_again(spark, monkeypatch):
    runs = []
    monkeypatch.setattr(catalog, "_silver_run", lambda spark, sf_dir: ("bronze", f"silver-{len(runs)}"))
    monkeypatch.setattr(catalog.sgold, "run_gold", lambda spark, silver, root, *a: runs.append((silver, root)))
    roots = [catalog._gold_run(spark, "/same/folder"), catalog._gold_run(spark, "/same/folder")]
    assert [r for _, r in runs] == roots and roots[0] != roots[1]
    assert [s for s, _ in runs] == ["silver-0", "silver-1"]
