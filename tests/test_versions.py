"""Versions of tables: whatever step a writer fails at, a reader finds the old table or the new one."""

import json
import os

import pytest

from basketspark.quality import contracts, gate
from basketspark.quality.errors import DataValidationError
from basketspark.sources import files, versions

CONTRACT = contracts.contract("t", [], [contracts.column("n", "long", minimum=0)], {"small": "n < 100"})
KEYED = contracts.contract("t", ["n"], [contracts.column("n", "long", minimum=0)])


def write(spark, path, n, contract=CONTRACT, **more):
    return gate.gated_write(spark.range(n).withColumnRenamed("id", "n"), contract, path, **more)


def rows(spark, path, version=None):
    return files.read_parquet(spark, path, version).count()


def test_versions_are_read_by_number(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 4, 5):
        write(spark, path, n)
    assert versions.versions(spark, path) == [2, 3] and rows(spark, path) == 5 and rows(spark, path, 2) == 4
    found = versions.commit_of(spark, path)
    assert (found.version, found.rows) == (3, 5) and json.loads(found.columns)["fields"][0]["name"] == "n"
    with pytest.raises(ValueError):
        files.read_parquet(spark, path, 1)
    assert sum(n.startswith("_data-") for n in os.listdir(path)) == 2


STEPS = ["write", "findings", "draft", "claim_before", "claim_after", "retire"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("first", [True, False])
def test_crash_at_each_step(spark, tmp_path, monkeypatch, step, first):
    """The process dies: nothing is cleaned up, not even by ``finally``."""
    path = str(tmp_path / "t")
    if not first:
        write(spark, path, 3)

    class Died(BaseException):
        pass

    def die(*_, **__):
        raise Died

    put, claim = versions.Store.put, versions.Store.claim

    def half(self, text, *below):
        put(self, text[: len(text) // 2], *below)
        raise Died

    def after(self, *a):
        claim(self, *a)
        raise Died

    monkeypatch.setattr(gate.versions, "discard", lambda *_: None)
    if step == "write":
        monkeypatch.setattr(gate, "write_parquet", lambda df, at: (files.write_parquet(df.limit(1), at), die()))
    elif step == "findings":
        monkeypatch.setattr(gate, "findings", die)
    elif step == "draft":
        monkeypatch.setattr(versions.Store, "put", half)
    elif step == "claim_before":
        monkeypatch.setattr(versions.Store, "claim", die)
    elif step == "claim_after":
        monkeypatch.setattr(versions.Store, "claim", after)
    elif step == "retire":
        monkeypatch.setattr(versions.Store, "names", lambda self, *below, f=versions.Store.names: f(self, *below) if below else die())
    with pytest.raises(Died):
        write(spark, path, 5)
    monkeypatch.undo()
    new = step in ("claim_after", "retire")
    if new or not first:
        assert rows(spark, path) == (5 if new else 3)
    else:
        assert versions.versions(spark, path) == []
    write(spark, path, 7)  # the next writer goes on
    assert rows(spark, path) == 7
    versions.retire(spark, path, 1, orphan_hours=0)
    assert rows(spark, path) == 7 and sum(n.startswith("_data-") for n in os.listdir(path)) == 1


def test_refused_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(DataValidationError) as e:
        write(spark, path, 130)
    assert os.listdir(tmp_path) == []
    assert [r.n for r in e.value.report.samples["small"]] == [*range(100, 120)] and [r.place for r in e.value.report.samples["small"]] == [*range(1, 21)]
    write(spark, path, 5)
    with pytest.raises(DataValidationError):
        write(spark, path, 130)
    assert rows(spark, path) == 5 and len([n for n in os.listdir(path) if n.startswith("_data-")]) == 1


def test_a_plain_folder_becomes_a_table_of_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(spark.range(9), path)
    files.write_parquet(spark.range(4), f"{path}/other_table")
    assert rows(spark, path) == 9 and versions.versions(spark, path) == []
    write(spark, path, 2)
    assert rows(spark, path) == 2 and any(n.startswith("part-") for n in os.listdir(path))  # a reader may still be in it
    write(spark, path, 3)
    assert rows(spark, path) == 3 and not any(n.startswith("part-") for n in os.listdir(path))
    assert rows(spark, os.path.join(path, versions.commit_of(spark, path).folder)) == 3
    assert rows(spark, f"{path}/other_table") == 4  # what isn't the table's stays
    plain = next(str(p) for p in (tmp_path / "t").rglob("part-*.parquet"))
    assert files.read_parquet(spark, plain).columns == ["n"]  # a file is no table of versions


def test_writers_at_the_same_time(spark, tmp_path, monkeypatch):
    """Each takes a number of its own; with ``base`` the later one is told."""
    path = str(tmp_path / "t")
    folders = []
    for n in range(4):
        folders.append(versions.new_folder())
        files.write_parquet(spark.range(n + 1), f"{path}/{folders[-1]}")
    got = [versions.commit(spark, path, folders[0])]
    known = versions.versions
    for f in folders[1:]:
        # The writer has looked before the one before it committed, so the number it tries is taken.
        stale = iter([known(spark, path)[:-1]])
        monkeypatch.setattr(versions, "versions", lambda s, p, stale=stale: next(stale, None) or known(s, p))
        got.append(versions.commit(spark, path, f))
        monkeypatch.undo()
    assert got == [1, 2, 3, 4] and [versions.commit_of(spark, path, v).folder for v in got] == folders
    assert not [n for n in os.listdir(f"{path}/_commits") if n.startswith("_draft")]
    with pytest.raises(RuntimeError):
        versions.commit(spark, path, folders[0], base=3)
    assert versions.commit(spark, path, folders[0], base=4) == 5
    with pytest.raises(ValueError):
        versions.retire(spark, path, 0)


def test_readers_of_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    write(spark, path, 3)
    begun = files.read_parquet(spark, path)
    write(spark, path, 8)
    assert begun.count() == 3 and rows(spark, path) == 8


def jobs_of(spark, call) -> int:
    """Jobs that a call starts in this thread."""
    sc, group = spark.sparkContext, f"group-{os.urandom(4).hex()}"
    sc.setJobGroup(group, "")
    try:
        call()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setJobGroup("", "")


def test_a_write_counts_as_it_writes(spark, tmp_path):
    """Constraints and rules on rows need no job but the write's own and the one that reads the footers' schema."""
    df = spark.range(50).withColumnRenamed("id", "n")
    plain = jobs_of(spark, lambda: (files.write_parquet(df, str(tmp_path / "plain")), spark.read.parquet(str(tmp_path / "plain"))))
    assert jobs_of(spark, lambda: write(spark, str(tmp_path / "t"), 50)) == plain
    assert jobs_of(spark, lambda: write(spark, str(tmp_path / "k"), 50, KEYED)) > plain
