"""No operator's own column meets one of its input: every name comes back as it was."""
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import ratecraft.llm
from ratecraft.llm import language_id, mixing, quality, repeats, sharding, simhash

FOLDER = Path(ratecraft.llm.__file__).parent
OPERATORS = {
    "sharding": (sharding, lambda df: sharding.shard_rows(df, "doc_id", sharding.regular_tree(4), sharding.regular_tree(5)), ["region", "rack", "shard", "slot", "grown_shard"]),
    "mixing": (mixing, lambda df: mixing.mix(df, {"lang": F.col("lang")}, {}, budget_share=1.0), ["epoch"]),
    "repeats": (repeats, repeats.remove_repeats, ["kept", "n_bytes", "n_removed", "removed"]),
    "quality": (quality, quality.classify, ["posterior", "score", "keep"]),
    "language_id": (language_id, lambda df: language_id.identify(df, language_id.fit(df)), ["lang_pred", "score"]),
    "simhash": (simhash, simhash.one_per_group, []),
}


def names_in(module) -> set[str]:
    """Every name in the module's source and the shared helpers that could be a column."""
    source = "".join(p.read_text() for p in (Path(module.__file__), FOLDER / "common.py", FOLDER / "components.py"))
    quoted = set(re.findall(r"\"([A-Za-z_][A-Za-z0-9_]{0,14})\"", source))
    return quoted | {"_d0", "_r0", "_g_shard", "carried", "_level0", "_key", "_raw", "_words", "_lid"}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names_come_back(docs_of, name):
    module, operator, results = OPERATORS[name]
    docs = docs_of([(i, f"some words of text number {i} that are quite plain. " * 3, "en", "src1") for i in range(6)])
    taken = {c.lower() for c in docs.columns} | set(results)
    extra = []
    for c in sorted(names_in(module)):
        if c.lower() not in taken:
            taken.add(c.lower())
            extra.append(c)
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in extra})
    out = operator(docs)
    assert [c for c in out.columns if c not in results] == docs.columns
    rows = out.collect()
    assert len(rows) == 6
    for r in rows:
        assert all(r[c] == f"{c}{r['doc_id']}" for c in extra)
