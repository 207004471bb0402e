"""quill: document-corpus analytics on Spark DataFrames.

Read pages / text / index files as tables, extract text, count tokens, split
into chunks, embed through a pluggable provider, keep a Parquet vector store
and answer batches of queries with exact top-k similarity search. Around the
core sit corpus operators (index files, link traversal, metadata-header
audits, line ownership, change logs, model-answer parsing).
"""

__version__ = "0.1.0"
