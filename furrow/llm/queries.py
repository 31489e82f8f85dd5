"""The queries of this package: name -> (plan, the same result in SQL or None)."""

from . import audit, bpe, chat, class_lm, fingerprint, negatives, packing, quality, repeats, simhash, toxicity, vafile, warc

QUERIES = {
    "op1_bpe": (bpe.op1_bpe, None),
    "op2_fingerprint": (fingerprint.op2_fingerprint, None),
    "op3_toxicity": (toxicity.op3_toxicity, None),
    "op4_simhash": (simhash.op4_simhash, None),
    "op5_class_lm": (class_lm.op5_class_lm, None),
    "op6_packing": (packing.op6_packing, None),
    "op7_warc": (warc.op7_warc, warc.OP7_SQL),
    "op8_quality": (quality.op8_quality, None),
    "op9_vafile": (vafile.op9_vafile, vafile.OP9_SQL),
    "op10_chat": (chat.op10_chat, chat.OP10_SQL),
    "op11_repeats": (repeats.op11_repeats, None),
    "op12_negatives": (negatives.op12_negatives, negatives.OP12_SQL),
    "op13_audit": (audit.op13_audit, audit.OP13_SQL),
}
