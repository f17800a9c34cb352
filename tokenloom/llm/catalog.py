"""The queries of this subpackage by name, with SQL where it can express them."""

from tokenloom.catalog.base import Entry
from tokenloom.llm import (
    attribution,
    centroids,
    codec,
    fingerprints,
    lines,
    mixing,
    near,
    packing,
    pii,
    quality,
    quantizer,
    secrets,
    urls,
)

ENTRIES: dict[str, Entry] = {
    "op1_url_filters": Entry("URL filters", urls.judged_pages),
    "op2_best_fit_packing": Entry("packing", packing.packed_documents),
    "op3_token_counts": Entry("token attribution", attribution.line_tokens),
    "op4_line_dedup": Entry("line dedup", lines.deduplicated_lines, lines.SQL),
    "op5_secret_scans": Entry("secrets", secrets.secrets_in_documents, secrets.SQL),
    "op6_document_fingerprints": Entry("fingerprints", fingerprints.fingerprinted_documents),
    "op7_bpe": Entry("BPE codec", codec.encoded_documents),
    "op8_pii": Entry("personal data", pii.personal_data_in_documents),
    "op9_near_dedup": Entry("near-duplicates", near.near_duplicate_documents),
    "op10_quality_rules": Entry("quality rules", quality.judged_documents),
    "op11_source_mixing": Entry("mixing sources", mixing.mixed_documents),
    "op12_centroid_clustering": Entry("clustering", centroids.clustered_vectors, centroids.SQL),
    "op13_vector_codes": Entry("vector codes", quantizer.compressed_vectors, quantizer.SQL),
}
