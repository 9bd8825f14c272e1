"""quillspark: document processing and retrieval as lazy PySpark plans."""
