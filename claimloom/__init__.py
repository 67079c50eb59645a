"""claimloom: evidence-curation analytics expressed as PySpark DataFrame plans."""
