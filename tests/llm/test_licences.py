from tidegate.llm import licences

SCHEMA = "doc_id long, path string, text string, dir string, licence string"
MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


def files(spark, rows):
    return spark.createDataFrame([(*r, "d", "l") for r in rows], SCHEMA)


def test_own_header_nearest_directory_and_odd_rows(spark):
    rows = [
        (1, "a/LICENSE", f"Some words.\n{MIT}\nmore"), (2, "a/b/c/code.py", "x = 1"),
        (3, "a/b/LICENCE.txt", GPL.upper()), (4, "a/b/c/own.py", f"# {MIT}\ncode"),
        (5, "a/other.py", "plain text\nof lines"), (6, "z/none.py", ""), (7, None, GPL),
        (8, None, None), (9, "a/b/c/d/e", "y"), (9, "a/b/c/d/e", "y"),
        (10, "a/COPYING.old/f.py", "z"), (None, "root.py", "the license of a version, under work")]
    got = {(r.doc_id, r.path): r for r in licences.scan(files(spark, rows)).collect()}
    assert {k[0]: v.licence for k, v in got.items()} == {
        1: "MIT", 2: "GPL-3.0", 3: "GPL-3.0", 4: "MIT", 5: "MIT", 6: None, 7: "GPL-3.0", 8: None,
        9: "GPL-3.0", 10: "MIT", None: None}
    assert got[(2, "a/b/c/code.py")].inherited_from == "a/b"
    assert got[(4, "a/b/c/own.py")].inherited_from is None
    assert licences.scan(files(spark, rows)).count() == len(rows)
    assert licences.scan(files(spark, [])).collect() == []
