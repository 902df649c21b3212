"""Test files are modules of one name space: a name that stands twice hides a file."""

from collections import Counter
from pathlib import Path


def test_file_names_are_unique():
    names = Counter(p.name for p in Path(__file__).parent.rglob("*.py") if p.name not in ("__init__.py", "conftest.py"))
    assert [n for n, k in names.items() if k > 1] == []
