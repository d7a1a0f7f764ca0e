"""Fingerprints of statement files in one pass that sorts no lines."""

from tallybook.sources.inbox import file_contents, list_files


def test_lines_are_not_sorted_by_file_and_broken_lines_are_found(spark, tmp_path):
    folder = tmp_path / "ann"
    folder.mkdir()
    texts = {"plain": "\n\nDate,Amount\n2024-01-05,1\n", "broken": 'Date,Narration\n2024-01-05,"two\nlines"\n', "blank": "\n \n", "quoted": 'Date\n"a ""b"" c"\n'}
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    contents = file_contents(spark, list_files(spark, str(folder)).collect())
    assert "SortAggregate" not in contents._jdf.queryExecution().executedPlan().toString()
    got = {r.file: (r.header, r.broken_lines) for r in contents.collect()}
    assert got == {"plain.csv": ("Date,Amount", False), "broken.csv": ("Date,Narration", True), "blank.csv": (None, False), "quoted.csv": ("Date", False)}
