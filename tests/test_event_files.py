from tidemark.sources.extractions import read_event_files


def test_malformed_rows_are_kept(spark, tmp_path):
    (tmp_path / "run1.json").write_text('{"a": 1}\n{"a": 2, "b\n{"a": 3}\n')
    (tmp_path / "index.json").write_text('{"a": 9}\n')
    got = {(r.a, r._corrupt_record) for r in read_event_files(spark, str(tmp_path), "a long").collect()}
    assert got == {(1, None), (None, '{"a": 2, "b'), (3, None)}
