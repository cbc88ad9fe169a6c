"""strandline: Spark-native cohort, pedigree, variant and data-quality operators.

Every public operator is a DataFrame-in / DataFrame-out function built on
Spark SQL expressions, joins, windows and Structured Streaming.
"""

from strandline.session import get_session, scratch_dir, ensure_checkpoint_dir

__all__ = ["get_session", "scratch_dir", "ensure_checkpoint_dir"]
