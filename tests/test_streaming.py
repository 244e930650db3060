from tidemark.streaming.ingest import new_extractions, run_available


def test_each_run_takes_only_new_files(spark, tmp_path):
    taken = []
    (tmp_path / "in").mkdir()

    def run():
        stream = new_extractions(spark, str(tmp_path / "in"), "S", "id long")
        run_available(stream, str(tmp_path / "checkpoint"), lambda df, _: taken.extend((r.id, r.src_file) for r in df.collect()))

    (tmp_path / "in" / "e_20240101_000000.json").write_text('{"id": 1}\n')
    run()
    run()
    (tmp_path / "in" / "e_20240201_000000.json").write_text('{"id": 2}\n')
    run()
    assert taken == [(1, "e_20240101_000000.json"), (2, "e_20240201_000000.json")]
