"""Column functions: byte alphabet, id codes, chunking, id arrays, request parts."""
