import re

import __spark_entry__ as entry


def test_one_query_an_operator():
    names = list(entry.queries())
    assert [n for n in range(1, 14) if sum(bool(re.match(f"op{n}_", x)) for x in names) != 1] == []
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
