"""Incremental work: new files in, the same batch functions per micro-batch."""
