"""quillstone: document analytics on PySpark DataFrames."""
