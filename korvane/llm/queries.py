"""The contract queries of this subpackage and their SQL."""

from __future__ import annotations

from . import clustering, ctw, langid, licenses, lines, mixing, packing, quality, simhash, vectors, warc, whitening

QUERIES = {
    "op1_ctw": ctw.op1_ctw,
    "op2_ann": vectors.op2_ann,
    "op3_warc": warc.op3_warc,
    "op4_mixing": mixing.op4_mixing,
    "op5_metric": vectors.op5_metric,
    "op6_packing": packing.op6_packing,
    "op7_langid": langid.op7_langid,
    "op8_quality": quality.op8_quality,
    "op9_simhash": simhash.op9_simhash,
    "op10_licenses": licenses.op10_licenses,
    "op11_whitening": whitening.op11_whitening,
    "op12_lines": lines.op12_lines,
    "op13_lloyd": clustering.op13_lloyd,
}
ORACLE_SQL = {"op3_warc": warc.OP3_SQL, "op4_mixing": mixing.OP4_SQL, "op5_metric": vectors.OP5_SQL, "op12_lines": lines.OP12_SQL, "op13_lloyd": clustering.OP13_SQL}
