"""Training-data operators over whole corpora of documents, pages and embeddings."""
