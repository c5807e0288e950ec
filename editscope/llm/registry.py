"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import chat, decontaminate, hnsw, html_text, langid, lattice_lm, lexical, merkle, packing, pii, quality, simhash, warc

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_chat": chat.op2_chat,
    "op3_html": html_text.op3_html,
    "op4_language": langid.op4_language,
    "op5_warc": warc.op5_warc,
    "op6_pii": pii.op6_pii,
    "op7_packing": packing.op7_packing,
    "op8_lattice": lattice_lm.op8_lattice,
    "op9_hnsw": hnsw.op9_hnsw,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_merkle": merkle.op11_merkle,
    "op12_quality": quality.op12_quality,
    "op13_lexical": lexical.op13_lexical,
}

ORACLE: dict[str, str] = {
    "op2_chat": chat.OP2_SQL,
    "op5_warc": warc.OP5_SQL,
    "op9_hnsw": hnsw.OP9_SQL,
    "op10_decontaminate": decontaminate.OP10_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op12_quality": quality.OP12_SQL,
    "op13_lexical": lexical.OP13_SQL,
}
