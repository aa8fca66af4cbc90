"""Every registered query against its SQL."""

import pytest

from obsidio.plans import registry

from .conftest import same_rows

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(name, spark, duck, sf):
    same_rows(QUERIES[name](spark, sf), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, sf):
    assert QUERIES[name](spark, sf).count() >= 0


def test_entry_imports_without_the_training_data_operators(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for name in ("obsidio", "__spark_entry__.py"):
        (shutil.copytree if (root / name).is_dir() else shutil.copy)(root / name, tmp_path / name)
    shutil.rmtree(tmp_path / "obsidio/llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'peer_performance' in q and not any(k.startswith('op') and '_' in k and k[2].isdigit() for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
