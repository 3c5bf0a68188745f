import __spark_entry__ as entry


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_are_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_an_error_inside_an_optional_module_is_raised(tmp_path, monkeypatch):
    import sys

    import pytest

    (tmp_path / "broken_mod.py").write_text("import a_module_that_is_nowhere\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    with pytest.raises(ModuleNotFoundError):
        entry._optional("broken_mod")
    sys.modules.pop("broken_mod", None)
    assert entry._optional("no_such_package_here.queries") is None
