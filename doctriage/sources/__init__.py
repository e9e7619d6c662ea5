"""Document discovery (binaryFile listings, file lists) and result readers."""
