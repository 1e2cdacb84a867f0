"""Training-data operators over corpora of documents, pages and embeddings. Nothing else in the library imports this."""
