"""The queries of this package: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from tickweave.llm.op1_mixing import OP1_SQL, op1_mixing
from tickweave.llm.op2_bpe import op2_bpe
from tickweave.llm.op3_jaccard_join import op3_jaccard_join
from tickweave.llm.op4_fingerprints import op4_fingerprints
from tickweave.llm.op5_topk import OP5_SQL, op5_topk
from tickweave.llm.op6_token_counts import op6_token_counts
from tickweave.llm.op7_suffix_dedup import op7_suffix_dedup
from tickweave.llm.op8_kneser_ney import op8_kneser_ney
from tickweave.llm.op9_toxicity import op9_toxicity
from tickweave.llm.op10_html_text import op10_html_text
from tickweave.llm.op11_sentencepiece import op11_sentencepiece
from tickweave.llm.op12_clustering import OP12_SQL, op12_clustering
from tickweave.llm.op13_resample import OP13_SQL, op13_resample

QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_bpe,
        op3_jaccard_join,
        op4_fingerprints,
        op5_topk,
        op6_token_counts,
        op7_suffix_dedup,
        op8_kneser_ney,
        op9_toxicity,
        op10_html_text,
        op11_sentencepiece,
        op12_clustering,
        op13_resample,
    )
}
ORACLE = {"op1_mixing": OP1_SQL, "op5_topk": OP5_SQL, "op12_clustering": OP12_SQL, "op13_resample": OP13_SQL}
