"""Operators for training-data pipelines: text, chat, web pages, archives, embeddings, packing, scoring."""
