"""Text files: quoted line ends, a declared delimiter, and the rule on row order."""
import pytest

from cohesion import map_entity
from cohesion.functions.predicates import SpecError
from cohesion.sources.readers import read_file, text_facts


def _file(tmp_path, text, name="x.csv", encoding="utf-8"):
    p = tmp_path / name
    p.write_bytes(text.encode(encoding))
    return str(p)


def test_quoted_line_ends_are_found(spark, tmp_path):
    path = _file(tmp_path, 'id,note\n1,"two\nlines"\n2,"a ""quoted"" word"\n3,plain\n')
    assert text_facts(spark, path) == ("UTF-8", True)
    got = read_file(spark, path).orderBy("__ord").select("id", "note").collect()
    assert [tuple(r) for r in got] == [(1, "two\nlines"), (2, 'a "quoted" word'), (3, "plain")]


def test_files_without_them_stay_splittable(spark, tmp_path):
    assert text_facts(spark, _file(tmp_path, 'id,note\n1,"a ""quoted"" word"\n')) == ("UTF-8", False)
    assert text_facts(spark, _file(tmp_path, "id,note\n1,café\n", "l.csv", "latin-1")) == ("ISO-8859-1", False)
    assert text_facts(spark, _file(tmp_path, "", "empty.csv")) == ("UTF-8", False)


def test_declared_delimiter(spark, tmp_path):
    got = read_file(spark, _file(tmp_path, "id;note\n1;x,y\n"), sep=";").select("id", "note").collect()
    assert [tuple(r) for r in got] == [(1, "x,y")]


def test_first_without_an_order_is_an_error(spark):
    df = spark.createDataFrame([(1, "x")], "pid int, v string")
    spec = {"entity": {"name": "S", "fields": {"base": ["v"]}},
            "filters": {"participant_id_field": "pid", "rows": [{"name": "f", "select": "first", "filter": [{"field": "v", "op": "is_not_null"}]}]},
            "mappings": [{"source_field": "v", "target_field": "v"}]}
    with pytest.raises(SpecError, match="row order"):
        map_entity(df, spec)
