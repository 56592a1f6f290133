"""tessera: a document-corpus analytics and retrieval engine written as Spark plans."""
