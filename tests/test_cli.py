import os

import pytest

from terracat.__main__ import main
from terracat.plans.integrity import IntegrityError

from .fixtures import data_source_csv, variable_source_csv, vocabulary_files


def test_cli_load_and_validate(spark, tmp_dir, capsys):
    csv = os.path.join(tmp_dir, "csv")
    files = vocabulary_files(csv)
    assert files
    data_source_csv(os.path.join(csv, "data_source.csv"))
    variable_source_csv(os.path.join(csv, "variable_source.csv"))
    assert main(["load", "--csv-dir", csv, "--out", os.path.join(tmp_dir, "out")]) == 0
    text = capsys.readouterr().out
    assert "geom_index: 5 rows" in text and "concept_relationship: 12 rows" in text
    assert "VIOLATION geom_index.table_desc length<=255: 1" in text
    with pytest.raises(IntegrityError):
        main(["load", "--csv-dir", csv, "--out", os.path.join(tmp_dir, "out2"), "--strict"])


def test_cli_nothing_to_load(spark, tmp_dir):
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    assert main(["load", "--csv-dir", empty, "--out", os.path.join(tmp_dir, "o")]) == 2
    vocabulary_files(empty)  # one group without the other is an error, and nothing is written
    assert main(["load", "--csv-dir", empty, "--out", os.path.join(tmp_dir, "o")]) == 2
    assert not os.path.exists(os.path.join(tmp_dir, "o"))
    assert main(["load", "--csv-dir", f"file://{empty}", "--out", os.path.join(tmp_dir, "o"), "--only", "vocabulary"]) == 0


def test_cli_refresh_keeps_tables(spark, tmp_dir, capsys):
    csv = os.path.join(tmp_dir, "csv")
    vocabulary_files(csv)
    data_source_csv(os.path.join(csv, "data_source.csv"))
    variable_source_csv(os.path.join(csv, "variable_source.csv"))
    out = os.path.join(tmp_dir, "out")
    assert main(["load", "--csv-dir", csv, "--out", out]) == 0
    capsys.readouterr()
    assert main(["load", "--csv-dir", csv, "--out", out, "--refresh"]) == 0
    text = capsys.readouterr().out
    assert "geom_index: 5 rows" in text and "vocabulary: 3 rows" in text   # nothing new to index or add
    assert "relationship: 6 rows" in text                                  # relationships append, as in the script
    assert "VIOLATION concept.concept_id primary key" in text              # concepts append: keys repeat
