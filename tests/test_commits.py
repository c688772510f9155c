"""The commit log: writers at once, writers that die, conflicts, and readers meanwhile."""

import threading

import pytest

from meterline.sources import commits, io


def pointers(spark, *rows):
    return spark.createDataFrame(rows, "date_utc string, load_folder string")


def shown(spark, path):
    return {r[0]: r[1] for r in io.read_pointers(spark, path).collect()}


def test_two_writers_from_one_state(spark, tmp_path, monkeypatch):
    """The second commits between the first one's read and its commit; neither is lost."""
    log = f"{tmp_path}/log"
    io.save_pointers(spark, log, pointers(spark, ("2024-01-01", "run=0")))
    real, rival = commits.commit, [pointers(spark, ("2024-01-03", "run=rival"))]

    def slow(*args):
        if rival:
            io.save_pointers(spark, log, rival.pop())
        return real(*args)

    monkeypatch.setattr(commits, "commit", slow)
    assert io.save_pointers(spark, log, pointers(spark, ("2024-01-02", "run=mine"))) == 3
    assert shown(spark, log) == {"2024-01-01": "run=0", "2024-01-02": "run=mine", "2024-01-03": "run=rival"}
    assert commits.versions(spark, log) == [1, 2, 3]


def test_many_writers_at_once(spark, tmp_path):
    log, failed = f"{tmp_path}/log", []

    def run(k):
        try:
            io.save_pointers(spark, log, pointers(spark, (f"2024-02-{k + 1:02d}", f"run={k}"), ("2024-03-01", f"run={k}")))
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=run, args=(k,)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = shown(spark, log)
    assert not failed and commits.versions(spark, log) == [1, 2, 3, 4, 5, 6]
    assert {k: v for k, v in got.items() if k < "2024-03"} == {f"2024-02-{k + 1:02d}": f"run={k}" for k in range(6)}
    assert not [p for p in (tmp_path / "log").iterdir() if p.name.startswith("_draft")]


def test_a_number_is_given_once(spark, tmp_path):
    log = f"{tmp_path}/log"
    assert commits.commit(spark, log, pointers(spark, ("a", "1")), 0)
    assert not commits.commit(spark, log, pointers(spark, ("a", "2")), 0)
    assert shown(spark, log) == {"a": "1"}


def test_a_writer_that_dies(spark, tmp_path, monkeypatch):
    log = f"{tmp_path}/log"
    io.save_pointers(spark, log, pointers(spark, ("2024-01-01", "run=0")))

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(commits, "_claim", die)
        io.save_pointers(spark, log, pointers(spark, ("2024-01-01", "run=1")))
    # One that dies without cleaning up leaves its draft.
    pointers(spark, ("2024-01-01", "run=2")).write.csv(f"{log}/_draft-0123")
    assert shown(spark, log) == {"2024-01-01": "run=0"}
    assert io.save_pointers(spark, log, pointers(spark, ("2024-01-01", "run=3"))) == 2
    assert shown(spark, log) == {"2024-01-01": "run=3"}


def test_conflicts_are_found_by_key(spark, tmp_path):
    log = f"{tmp_path}/log"
    base = io.save_pointers(spark, log, pointers(spark, ("2024-01-01", "run=0"), ("2024-01-02", "run=0")))
    io.save_pointers(spark, log, pointers(spark, ("2024-01-01", "run=1")), base)
    with pytest.raises(commits.Conflict, match="2024-01-01"):
        io.save_pointers(spark, log, pointers(spark, ("2024-01-01", "run=2")), base)
    io.save_pointers(spark, log, pointers(spark, ("2024-01-02", "run=2")), base)
    assert shown(spark, log) == {"2024-01-01": "run=1", "2024-01-02": "run=2"}


def test_versions_stay_readable_until_pruned(spark, tmp_path):
    log = f"{tmp_path}/log"
    for k in range(5):
        io.save_pointers(spark, log, pointers(spark, ("d", f"run={k}")))
    assert commits.read(spark, log, io.POINTERS, 2)[1].first()["load_folder"] == "run=1"
    commits.prune(spark, log, 2)
    assert commits.versions(spark, log) == [4, 5] and shown(spark, log) == {"d": "run=4"}
    with pytest.raises(ValueError):
        commits.prune(spark, log, 0)


def test_history_of_runs_at_once(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/t"
    rows = lambda *r: spark.createDataFrame(r, "day string, v long")
    assert commits.read_table(spark, root, "h") is None
    io.save_history(spark, root, "h", rows(("a", 1), ("a", 2), ("b", 1)), "day")
    real, rival = commits.update, [rows(("c", 7))]

    def slow(*args, **more):
        if rival:
            io.save_history(spark, root, "h", rival.pop(), "day")
        return real(*args, **more)

    monkeypatch.setattr(commits, "update", slow)
    io.save_history(spark, root, "h", rows(("a", 9)), "day")
    assert sorted(tuple(r) for r in commits.read_table(spark, root, "h").collect()) == [("a", 9), ("b", 1), ("c", 7)]
    io.save_history(spark, root, "other", rows(("z", 0)), "day")
    assert commits.read_table(spark, root, "h").count() == 3


def test_a_store_without_links(spark, tmp_path):
    """Through a file system that isn't the local one, numbers are given by a rename that doesn't overwrite."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.commits.link./in", f"file://{tmp_path}")
    log = "viewfs://commits/in/log"
    assert io.save_pointers(spark, log, pointers(spark, ("a", "1"))) == 1
    assert not commits.commit(spark, log, pointers(spark, ("a", "9")), 0)
    assert io.save_pointers(spark, log, pointers(spark, ("b", "2"))) == 2
    assert shown(spark, log) == {"a": "1", "b": "2"}
