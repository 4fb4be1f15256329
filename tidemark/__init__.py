"""Change-data-capture folding, retrieval and ranking audits as native Spark plans."""
