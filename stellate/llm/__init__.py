"""Training-data operators: thirteen corpus operators, one module each, and their queries.

Nothing outside this folder (but ``corpus_pipeline.py``) imports it. Each module states its
method, its result on nulls, empty texts, ties and repeated rows, and what bounds its memory.
"""
