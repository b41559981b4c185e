"""The entry module without its optional part."""
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(code, tmp_path, **files):
    """Runs ``code`` in a copy of the library's entry without the optional part."""
    import shutil
    shutil.copy(f"{HERE}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{HERE}/tramline", tmp_path / "tramline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name, text in files.items():
        path = tmp_path / name.replace("__", "/").replace("_py", ".py")
        os.makedirs(path.parent, exist_ok=True)
        path.write_text(text)
    return subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)


COUNT = "import __spark_entry__ as E; assert set(E.queries()) == set(E.QUERIES) == set(E.oracle_sql()); print(len(E.queries()))"


def test_without_the_optional_part(tmp_path):
    got = _run(COUNT, tmp_path)
    assert got.returncode == 0 and int(got.stdout) > 90, got.stderr


def test_without_a_package_that_only_it_needs(tmp_path):
    got = _run(COUNT, tmp_path, corpus_pipeline_py="import a_package_nobody_has\n", tramline__llm__queries_py="QUERIES = ORACLE_SQL = {}\n")
    assert got.returncode == 0 and "not registered" in got.stderr


def test_a_broken_import_inside_the_library_is_an_error(tmp_path):
    got = _run(COUNT, tmp_path, corpus_pipeline_py="from tramline.llm.queries import nothing\n", tramline__llm__queries_py="QUERIES = {}\n")
    assert got.returncode != 0 and "nothing" in got.stderr
