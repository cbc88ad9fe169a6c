"""Training-data operators: mixing, language id, secrets, toxicity, near-duplicates, digests, BPE, ANN, chat, WARC.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
