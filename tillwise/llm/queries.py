"""Registered queries of this subpackage: the whole table in, the full result out."""

from __future__ import annotations

from tillwise.llm import chat, htmltext, lexical, minhash, mixing, mixlm, neighbours, oracles, packing, secrets, sharding, simhash, spelling, toxicity
from tillwise.llm.common import table


def _over(name, fn):
    def run(spark, sf_dir):
        return fn(table(spark, sf_dir, name))

    run.__doc__ = fn.__doc__
    return run


QUERIES = {
    "op1_simhash": _over("documents", simhash.op1),
    "op2_minhash": _over("documents", minhash.op2),
    "op3_neighbours": _over("embeddings", neighbours.op3),
    "op4_mixing": _over("documents", mixing.op4),
    "op5_packing": _over("documents", packing.op5),
    "op6_htmltext": _over("pages", htmltext.op6),
    "op7_mixlm": _over("documents", mixlm.op7),
    "op8_toxicity": toxicity.op8,
    "op9_secrets": _over("documents", secrets.op9),
    "op10_sharding": _over("documents", sharding.op10),
    "op11_chat": _over("conversations", chat.op11),
    "op12_spelling": _over("documents", spelling.op12),
    "op13_lexical": lexical.op13,
}

#: DuckDB SQL where it can express the whole result.
ORACLES: dict[str, str] = {"op4_mixing": oracles.MIXING, "op9_secrets": oracles.SECRETS,
                            "op11_chat": oracles.CHAT, "op13_lexical": oracles.LEXICAL}
