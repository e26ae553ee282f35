"""Defaults of the whole program (fixed values, so that runs compare)."""

REDIRECT_HOPS = 4
BLOB_SHARDS = 1000
CSV_SHARDS = 8
MANIFEST_VERSION = 4
STORE_DIR = "graph.store"
PAGERANK_ITERATIONS = 20
PAGERANK_DAMPING = 0.85
PAGERANK_EPSILON = 1e-6
LABEL_ROUNDS = 50

#: Base name of each table, its header, and its constant third column (fixed values of the export format).
TABLES = {
    "nodes": (("id:ID", "title", ":LABEL"), "Page"),
    "edges": ((":START_ID", ":END_ID", ":TYPE"), None),
    "categories": (("id:ID(Category)", "name", ":LABEL"), "Category"),
    "article_categories": ((":START_ID", ":END_ID(Category)", ":TYPE"), "HAS_CATEGORY"),
    "image_nodes": (("id:ID(Image)", "filename", ":LABEL"), "Image"),
    "article_images": ((":START_ID", ":END_ID(Image)", ":TYPE"), "HAS_IMAGE"),
    "external_link_nodes": (("id:ID(ExternalLink)", "url", ":LABEL"), "ExternalLink"),
    "article_external_links": ((":START_ID", ":END_ID(ExternalLink)", ":TYPE"), "HAS_LINK"),
}
#: Tables whose first column is unique over shards.
UNIQUE = ("categories", "image_nodes", "external_link_nodes")
