"""Writers: stored tables, tab-separated lists, VCF text and document lines."""
