"""The entry module with and without the llm subpackage."""

import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parents[1])


def names(prelude: str) -> tuple[set[str], set[str]]:
    code = (f"import sys; sys.path.insert(0, {REPO!r}); {prelude}\n"
            "import __spark_entry__ as e\n"
            "print(*e.queries()); print(*e.oracle_sql())")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    queries, oracle = out.stdout.splitlines()[-2:]
    return set(queries.split()), set(oracle.split())


def test_entry_without_the_llm_subpackage():
    queries, oracle = names("sys.modules['ledgerlens.llm'] = None;"
                            " sys.modules['corpus_pipeline'] = None")
    assert "merged_features" in queries and oracle <= queries
    assert not any(q.startswith("op") and q[2].isdigit() for q in queries)
    assert "pipeline" not in queries


def test_nothing_else_imports_the_llm_subpackage():
    package = Path(REPO) / "ledgerlens"
    for path in package.rglob("*.py"):
        if "llm" not in path.parts:
            text = path.read_text()
            assert "llm" not in text, path


def test_another_missing_module_is_an_error():
    for missing in ("zstandard", "public_tokenizers"):
        code = (f"import sys; sys.path.insert(0, {REPO!r}); sys.modules[{missing!r}] = None\n"
                "import __spark_entry__")
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
        assert out.returncode and missing in out.stderr
