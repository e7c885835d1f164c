"""One function per user-level operation, DataFrame in and DataFrame out."""
