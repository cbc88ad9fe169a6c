"""Column-level functions (built-in expressions only; no Python UDFs).

Re-exports the scalar helpers used across the operators so that a user can
apply them in their own ``select``/``withColumn``.
"""

from strandline.functions.sizes import human_size
from strandline.operators.catalog import file_prefix, gzip_name, path_param, s3_parts
from strandline.operators.cohort import json_list, urlsafe_hash
from strandline.operators.pedigree import api_sex, name_aliquot, name_analysis, sample_name
from strandline.operators.refdata import extract_version, merge_keyed_version, verify_checksum
from strandline.operators.tracks import escape_percent
from strandline.operators.variants import document_hash

__all__ = [
    "human_size", "file_prefix", "gzip_name", "path_param", "s3_parts", "json_list", "urlsafe_hash", "api_sex",
    "name_aliquot", "name_analysis", "sample_name", "extract_version", "merge_keyed_version", "verify_checksum",
    "escape_percent", "document_hash",
]
