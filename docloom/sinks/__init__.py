"""Where results go: files by name, the upload state, and the remote knowledge base."""
