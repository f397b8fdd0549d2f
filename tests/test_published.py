import os

import pytest

from terracat.__main__ import main
from terracat.contracts import CONTRACTS
from terracat.plans.integrity import IntegrityError
from terracat.plans.load import FRAGMENT_FILES, load_published, point_tables
from terracat.sources import published

from .conftest import rows
from .fixtures import data_source_csv, variable_source_csv, vocabulary_files


def files(folder):
    vocabulary_files(folder)
    data_source_csv(os.path.join(folder, "data_source.csv"))
    variable_source_csv(os.path.join(folder, "variable_source.csv"))
    return folder


def contents(spark, root):
    return {k: rows(v) for k, v in published.read_published(spark, root).items()}


def accept(rule):
    """The fixture's own two repeated keys; no more of them."""
    return rule.rule != "primary key" or rule.n_violations == 1


def test_bad_rows_and_broken_keys_leave_every_old_table(spark, tmp_dir):
    csv, root = files(os.path.join(tmp_dir, "csv")), os.path.join(tmp_dir, "root")
    load_published(spark, csv, root, tolerate=accept)
    before = contents(spark, root)
    assert len(before) == 10 and all(before.values())
    sixth = os.path.join(csv, FRAGMENT_FILES["concept_relationship"])
    good = open(sixth, encoding="utf-8").read()
    for change in ("not,enough\n", good.splitlines()[1] + "\n"):  # a bad row in the sixth file; a key twice
        with open(sixth, "w", encoding="utf-8") as f:
            f.write(good + change)
        with pytest.raises(Exception) as failure:
            load_published(spark, csv, root, tolerate=accept)
        assert ("primary key" in str(failure.value)) == (change != "not,enough\n")
        assert contents(spark, root) == before and published.current(spark, root)[0] == 1
        assert [n for n in os.listdir(root) if n.startswith("v")] == [os.path.basename(os.path.dirname(os.path.dirname(published.current(spark, root)[1]["concept"])))]
    os.remove(os.path.join(csv, FRAGMENT_FILES["domain"]))  # a missing file
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_published(spark, csv, root, tolerate=accept)
    assert contents(spark, root) == before


def test_next_version_replaces_all_and_groups_are_kept(spark, tmp_dir):
    csv, root = files(os.path.join(tmp_dir, "csv")), os.path.join(tmp_dir, "root")
    load_published(spark, csv, root, tolerate=accept)
    before = contents(spark, root)
    names = point_tables(spark, root, "tc_published")
    assert rows(spark.table("tc_published.concept")) == before["concept"] and len(names) == 10
    # the catalog alone: vocabulary tables are carried over, the audit sees all of them
    load_published(spark, csv, root, only="catalog", refresh=True, tolerate=accept)
    number, paths = published.current(spark, root)
    assert number == 2 and contents(spark, root) == before and "v00000001" in paths["concept"] and "v00000002" in paths["geom_index"]
    load_published(spark, csv, root, tolerate=accept)
    published.prune(spark, root, keep=1)
    assert contents(spark, root) == before and [n for n, _ in published.versions(spark, root)] == [3]
    assert len([n for n in os.listdir(root) if n.startswith("v")]) == 1
    point_tables(spark, root, "tc_published")
    assert rows(spark.table("tc_published.concept")) == before["concept"]


def test_one_of_two_writers_wins(spark, tmp_dir):
    root = os.path.join(tmp_dir, "root")

    def write(k):
        def inner(folder):
            spark.range(k).write.parquet(f"{folder}/t")
            if k == 5:  # another writer publishes meanwhile
                published.publish(spark, root, write(3))
            return {"t": f"{folder}/t"}
        return inner
    with pytest.raises(published.PublishConflict):
        published.publish(spark, root, write(5))
    assert published.read_published(spark, root)["t"].count() == 3 and published.current(spark, root)[0] == 1
    assert len([n for n in os.listdir(root) if n.startswith("v")]) == 1
    with open(os.path.join(root, "_published", "00000002.json"), "w") as f:
        f.write('{"t": "unfin')  # a marker still being written does not count
    assert published.current(spark, root)[0] == 1


def test_strict_command_line_keeps_old_tables(spark, tmp_dir, capsys):
    csv, out = files(os.path.join(tmp_dir, "csv")), os.path.join(tmp_dir, "out")
    assert main(["load", "--csv-dir", csv, "--out", out, "--publish"]) == 0
    assert "geom_index: 5 rows" in capsys.readouterr().out
    before = contents(spark, out)
    with pytest.raises(IntegrityError):
        main(["load", "--csv-dir", csv, "--out", out, "--strict"])
    assert contents(spark, out) == before and set(before) <= set(CONTRACTS)
    assert main(["load", "--csv-dir", os.path.join(tmp_dir, "none"), "--out", out, "--publish"]) == 2
