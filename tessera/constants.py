"""Every tunable of the engine, once. Results depend on them."""

WINDOW, OVERLAP, MIN_CHUNK, MIN_ADVANCE = 650, 150, 40, 216
CHARS_PER_TOKEN = 2
FINGERPRINT_FLOOR = 200
EVIDENCE_MAX = 280
SHINGLE, TWIN_JACCARD, TWIN_LENGTH_RATIO = 10, 0.85, 0.15
EMBED_DIM, MIN_EMBED_DIM = 1024, 512
RRF_K, VECTOR_WEIGHT, KEYWORD_WEIGHT = 60, 1.0, 1.0
LIMIT, CANDIDATES, SCOPED_CANDIDATES = 5, 40, 300
SECTION_CAP = 1
RERANK_CANDIDATES, RERANK_WEIGHT, RERANK_DIGITS = 16, 3.0, 4
ALIAS_VARIANTS = 8
BM25_K1, BM25_B, BM25_IDF_FLOOR = 1.2, 0.75, 1e-6
GRAPH_DEPTH_MAX, RELATED_DOCS, PASSAGES_PER_DOC, HUB_CAP, CONNECTIVES = 12, 5, 2, 24, 4
SNIPPET = 400
CACHE_CHECKPOINT, VERIFY_COSINE = 256, 0.97
ARM_TOLERANCE, KIND_TOLERANCE, GRAPH_TOLERANCE = 0.02, 0.08, 0.05
CLASSIFY_HEAD = 8000
QUIET_SECONDS = 1.0
REPLACEMENT_RATIO = 0.005

#: Formats by how much of a document they keep, best last.
FORMAT_PRIORITY = {"pdf": 1, "ppt": 2, "pptx": 3, "xls": 4, "xlsx": 5, "doc": 6, "docx": 7, "hwpx": 8, "hwp": 9}
#: Weight of an edge by its relation; others weigh OTHER_WEIGHT.
RELATION_WEIGHTS = {"depends_on": 1.0, "imports": 1.0, "delegates_to": 1.0, "uses": 0.8, "defines": 0.8, "supersedes": 0.6, "references": 0.5, "related_to": 0.4}
OTHER_WEIGHT = 0.3
#: Which kind an entity has when sources disagree, best first.
KIND_PRIORITY = ("document", "module", "symbol", "unknown")
