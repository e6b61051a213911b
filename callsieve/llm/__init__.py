"""Training-data operations on document and vector tables. Nothing outside this folder imports it."""
