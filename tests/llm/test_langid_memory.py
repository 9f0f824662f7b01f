"""The sample of the language model reaches training as views, in the order of its ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from postpulse.llm import langid


def test_rows_are_views_in_order():
    lists = lambda rows: pa.array(rows, pa.list_(pa.int32()))
    parts = {"doc_id": [3, 1, 1, 2], "lang": ["b", "b", "a", "c"], "at": lists([[1, 2], [], [5], [7, 8, 9]]), "counts": lists([[1, 1], [], [2], [3, 4, 5]])}
    table = pa.table(parts)
    rows = langid.rows_of(pa.concat_tables([table.slice(0, 2), table.slice(2)]))
    assert [(lang, at.tolist(), n.tolist()) for lang, at, n in rows] == [("a", [5], [2]), ("b", [], []), ("c", [7, 8, 9], [3, 4, 5]), ("b", [1, 2], [1, 1])]
    assert all(np.shares_memory(at.base, rows[0][1].base) for _, at, _ in rows if len(at))
    assert langid.rows_of(table.slice(0, 0)) == []
