"""Both engines derive the same domain tables."""

import pytest

from compare import assert_same
from shopfloor import bindings


@pytest.mark.parametrize("name", sorted(set(bindings.SQL) | set(bindings.ORACLE_SQL)))
def test_binding_matches(spark, duck, folder, name):
    ctes = ",\n".join(bindings.oracle_ctes(name))
    assert assert_same(bindings.Domain(spark, folder)[name], duck, f"WITH {ctes} SELECT * FROM {name}") > 0
