"""Training-data pipeline operators over documents, pages, vectors and
conversations, each in a module of its own.  Nothing outside this package (and
``corpus_pipeline.py``) imports it.
"""
