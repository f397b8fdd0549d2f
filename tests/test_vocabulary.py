import os

from terracat.plans import integrity
from terracat.plans import vocabulary as voc
from terracat.plans.load import load_vocabulary_files
from terracat.sources import read_fragment

from .fixtures import vocabulary_files


def _frags(spark, tmp_dir):
    files = vocabulary_files(os.path.join(tmp_dir, "vocab"))
    return {k: read_fragment(spark, p, k) for k, p in files.items()}


def test_promotion_filters_new_rows_except_relationships(spark, tmp_dir):
    f = _frags(spark, tmp_dir)
    existing = {"vocabulary": f["vocabulary"].where("vocabulary_id = 'None'"),
                "domain": f["domain"].where("domain_id = 'Metadata'")}
    promoted = voc.promote_all({k: f[k] for k in ("vocabulary", "concept_class", "domain", "relationship")},
                               existing)
    got = sorted((r.concept_id, r.vocabulary_id) for r in promoted.collect())
    assert got == [(2000000001, "Vocabulary"), (2000000002, "Vocabulary"),
                   (2000000010, "Concept Class"), (2000000011, "Concept Class"),
                   (2000000020, "Domain"),
                   (2000000200, "Relationship"), (2000000201, "Relationship"), (2000000202, "Relationship")]
    r = promoted.where("concept_id = 2000000020").first()
    assert (r.domain_id, r.concept_code, str(r.valid_start_date), str(r.valid_end_date)) == \
        ("Metadata", "OMOP generated", "1970-01-01", "2099-12-31")
    assert r.standard_concept is None and r.invalid_reason is None


def test_new_set_feeds_both_concepts_and_dimension(spark, tmp_dir):
    f = _frags(spark, tmp_dir)
    existing = f["vocabulary"].where("vocabulary_id = 'None'")
    concepts, dim_rows = voc.merge_metadata(f["vocabulary"], existing, "vocabulary")
    assert sorted(r.vocabulary_id for r in dim_rows.collect()) == ["GIS", "SDOH"]
    assert concepts.count() == dim_rows.count()


def test_concept_names_cut_to_255(spark, tmp_dir):
    f = _frags(spark, tmp_dir)
    c = {r.concept_id: r.concept_name for r in voc.load_concepts(f["concept"]).collect()}
    assert len(c[2000000101]) == 255 and c[2000000102] == "" and c[2000000100] == "County"


def test_reverse_completion(spark, tmp_dir):
    f = _frags(spark, tmp_dir)
    edges = voc.load_concept_relationships(f["concept_relationship"])
    added = sorted(tuple(r)[:3] for r in voc.complete_reverse(edges, f["relationship"]).collect())
    assert added == [(44000, 2000000101, "Geom of"),
                     (2000000105, 2000000104, "Geom of"), (2000000105, 2000000104, "Geom of")]
    # the load script's literal form re-proposes an existing standard -> minted edge
    literal = sorted(tuple(r)[:3] for r in voc.complete_reverse(edges, f["relationship"], literal=True).collect())
    assert (45000, 2000000102, "Geom of") in literal and len(literal) == 4
    completed = voc.with_reverse(edges, f["relationship"])
    # two labels sharing one reverse label collide: the key check reports it
    dups = integrity.duplicate_keys(completed, voc.EDGE_KEY).collect()
    assert [(d.concept_id_1, d.concept_id_2, d.relationship_id, d.n) for d in dups] == \
        [(2000000105, 2000000104, "Geom of", 2)]
    # completion is a fixed point
    assert voc.complete_reverse(completed, f["relationship"]).count() == 0


def test_load_vocabulary_files(spark, tmp_dir):
    files = vocabulary_files(os.path.join(tmp_dir, "vocab"))
    out = load_vocabulary_files(spark, os.path.dirname(files["concept"]), os.path.join(tmp_dir, "out"))
    assert out["vocabulary"].count() == 3 and out["domain"].count() == 2
    assert out["relationship"].count() == 3
    assert out["concept"].count() == 3 + 2 + 2 + 3 + 4
    assert out["concept_relationship"].count() == 9 + 3
    summary = {(r.table_name, r.rule, r.column_name): r.n_violations
               for r in integrity.check_tables({k: out[k] for k in out}).collect()}
    assert summary[("concept_relationship", "primary key", "concept_id_1,concept_id_2,relationship_id")] == 1
    # 'None' vocabulary and 'Metadata' domain are both promoted as concept 0
    assert summary[("concept", "primary key", "concept_id")] == 1
    assert summary[("concept_relationship", "references relationship.relationship_id", "relationship_id")] == 1
    assert summary[("vocabulary", "references concept.concept_id", "vocabulary_concept_id")] == 0
    # promoted concepts name the metadata vocabularies, which a fragment-only load lacks
    assert summary[("concept", "references vocabulary.vocabulary_id", "vocabulary_id")] == 10
    assert summary[("concept", "required", "concept_name")] == 0


def test_existing_dimension_rows_are_never_updated(spark, tmp_dir):
    f = _frags(spark, tmp_dir)
    existing_vocab = spark.createDataFrame([("None", "Old name", None, "v0", 0)],
                                           f["vocabulary"].schema)
    out = voc.load_vocabulary({"vocabulary": f["vocabulary"]}, {"vocabulary": existing_vocab})
    got = {r.vocabulary_id: r.vocabulary_name for r in out["vocabulary"].collect()}
    assert got == {"None": "Old name", "GIS": "GIS vocabulary", "SDOH": "Social determinants"}
    # only the two new vocabularies were promoted
    assert sorted(r.concept_id for r in out["concept"].collect()) == [2000000001, 2000000002]


def test_vocabulary_load_rerun_is_idempotent(spark, tmp_dir):
    files = vocabulary_files(os.path.join(tmp_dir, "vocab"))
    out_dir = os.path.join(tmp_dir, "out")
    first = {k: sorted(map(tuple, v.collect())) for k, v in
             load_vocabulary_files(spark, os.path.dirname(files["concept"]), out_dir).items()}
    second = {k: sorted(map(tuple, v.collect())) for k, v in
              load_vocabulary_files(spark, os.path.dirname(files["concept"]), out_dir).items()}
    assert first == second


def test_incremental_load_over_own_tables(spark, tmp_dir):
    """A second load whose existing tables are read from the output folder
    (incremental use) replaces them without reading overwritten files."""
    files = vocabulary_files(os.path.join(tmp_dir, "vocab"))
    out_dir = os.path.join(tmp_dir, "out")
    frag_dir = os.path.dirname(files["concept"])
    load_vocabulary_files(spark, frag_dir, out_dir)
    existing = {k: spark.read.parquet(os.path.join(out_dir, "vocabulary", k))
                for k in ("vocabulary", "domain", "concept_class")}
    out = load_vocabulary_files(spark, frag_dir, out_dir, existing=existing)
    # every fragment key already exists: no dimension row is added twice
    assert out["vocabulary"].count() == 3 and out["domain"].count() == 2
    assert out["concept_class"].count() == 2


from collections import Counter  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_IDS = [5, 7, 2000000001, 2000000002, 2000000003]
_RELS = {"A": "B", "B": "A", "C": "B", "D": None}     # C shares B's reverse; D has no relationship row


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(_IDS), st.sampled_from(_IDS), st.sampled_from(list(_RELS))),
                max_size=25))
def test_complete_reverse_matches_brute_force(spark, edge_list):
    import datetime as dt
    d0, d1 = dt.date(1970, 1, 1), dt.date(2099, 12, 31)
    edges = spark.createDataFrame([(a, b, r, d0, d1, None) for a, b, r in edge_list],
                                  "concept_id_1 long, concept_id_2 long, relationship_id string, "
                                  "valid_start_date date, valid_end_date date, invalid_reason string")
    rel = spark.createDataFrame([(k, v) for k, v in _RELS.items() if v is not None],
                                "relationship_id string, reverse_relationship_id string")
    got = Counter((r.concept_id_1, r.concept_id_2, r.relationship_id)
                  for r in voc.complete_reverse(edges, rel).collect())
    present = {(a, b, r) for a, b, r in edge_list}
    want = Counter((b, a, _RELS[r]) for a, b, r in edge_list
                   if a > 2_000_000_000 and _RELS[r] is not None and (b, a, _RELS[r]) not in present)
    assert got == want


def test_files_are_parsed_before_the_clustered_writes(spark, tmp_dir, monkeypatch):
    """A clustered write reads its rows twice, and a dimension is read again for
    its concepts: neither goes back to the CSV files."""
    from terracat.plans import load
    plans, real = {}, load.write_clustered

    def write(df, path, keys):
        plans[os.path.basename(path)] = df._jdf.queryExecution().executedPlan().toString()
        real(df, path, keys)
    monkeypatch.setattr(load, "write_clustered", write)
    out = load_vocabulary_files(spark, os.path.dirname(vocabulary_files(tmp_dir)["concept"]), os.path.join(tmp_dir, "out"))
    assert set(plans) == set(out) and all(df.count() for df in out.values())
    assert not [name for name, plan in plans.items() if "FileScan csv" in plan]
