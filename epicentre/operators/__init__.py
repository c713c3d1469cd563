"""DataFrame -> DataFrame operators: staging, marts, merge, serving, quality."""
