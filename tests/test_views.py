"""Names of views and queries are given once: a second one in a literal would silently take the first one's place."""

import ast
from pathlib import Path

import pytest

PLANS = Path(__file__).resolve().parents[1] / "casequarry" / "plans"


@pytest.mark.parametrize("path", sorted(PLANS.glob("*.py")), ids=lambda p: p.stem)
def test_names_are_given_once(path):
    for node in ast.walk(ast.parse(path.read_text())):
        if isinstance(node, ast.Dict):
            names = [k.value for k in node.keys if isinstance(k, ast.Constant)]
            assert len(names) == len(set(names)), sorted({n for n in names if names.count(n) > 1})
