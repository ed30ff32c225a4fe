"""The registered queries of this package and their DuckDB SQL."""

from candleflow.llm.ann import op4_adaptive_scan
from candleflow.llm.byteconv import op1_byte_conv_quality
from candleflow.llm.fingerprints import op12_bottom_k_fingerprints
from candleflow.llm.fingerprints import oracle_sql as fingerprint_sql
from candleflow.llm.huffman import op2_huffman_ids
from candleflow.llm.lexical import op11_ranked_search
from candleflow.llm.lexical import oracle_sql as search_sql
from candleflow.llm.manifest import op13_merkle_manifest
from candleflow.llm.manifest import oracle_sql as manifest_sql
from candleflow.llm.segment import op9_n_best_pieces
from candleflow.llm.warc import op5_warc_salvage
from candleflow.llm.warc import oracle_sql as archive_sql
from candleflow.llm.licenses import op6_license_scan
from candleflow.llm.licenses import oracle_sql as license_sql
from candleflow.llm.linededup import op7_line_dedup
from candleflow.llm.minhash import op8_bag_minhash
from candleflow.llm.nndescent import op3_nn_descent
from candleflow.llm.nndescent import oracle_sql as link_sql
from candleflow.llm.packing import op10_best_fit_packing

QUERIES = {
    "op1_byte_conv_quality": op1_byte_conv_quality,
    "op2_huffman_ids": op2_huffman_ids,
    "op3_nn_descent": op3_nn_descent,
    "op4_adaptive_scan": op4_adaptive_scan,
    "op5_warc_salvage": op5_warc_salvage,
    "op6_license_scan": op6_license_scan,
    "op7_line_dedup": op7_line_dedup,
    "op8_bag_minhash": op8_bag_minhash,
    "op9_n_best_pieces": op9_n_best_pieces,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_ranked_search": op11_ranked_search,
    "op12_bottom_k_fingerprints": op12_bottom_k_fingerprints,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE = {
    "op3_nn_descent": link_sql(),
    "op5_warc_salvage": archive_sql(),
    "op6_license_scan": license_sql(),
    "op11_ranked_search": search_sql(),
    "op12_bottom_k_fingerprints": fingerprint_sql(),
    "op13_merkle_manifest": manifest_sql(),
}
