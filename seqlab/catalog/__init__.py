from seqlab.catalog import exam_queries, read_queries, sheet_queries  # noqa: F401
from seqlab.catalog.base import ORACLE, QUERIES  # noqa: F401
