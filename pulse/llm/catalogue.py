"""Queries of this package and their SQL, by name."""

from __future__ import annotations

from . import bitpack, chat, chunked_bpe, ctw, decontam, dialogue_repair, licences, merkle, minhash, packing, quality, urlfilter, warc

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_decontamination": decontam.op3_decontamination,
    "op4_chat_rotation": chat.op4_chat_rotation,
    "op5_licences": licences.op5_licences,
    "op6_url_filter": urlfilter.op6_url_filter,
    "op7_minhash_dedup": minhash.op7_minhash_dedup,
    "op8_token_bits": bitpack.op8_token_bits,
    "op9_ctw": ctw.op9_ctw,
    "op10_warc": warc.op10_warc,
    "op11_dialogue_repair": dialogue_repair.op11_dialogue_repair,
    "op12_merkle": merkle.op12_merkle,
    "op13_chunked_bpe": chunked_bpe.op13_chunked_bpe,
}

SQL = {
    "op2_quality_rules": quality.SQL_OP2,
    "op3_decontamination": decontam.SQL_OP3,
    "op4_chat_rotation": chat.SQL_OP4,
    "op6_url_filter": urlfilter.SQL_OP6,
    "op10_warc": warc.SQL_OP10,
    "op11_dialogue_repair": dialogue_repair.SQL_OP11,
    "op12_merkle": merkle.SQL_OP12,
}
