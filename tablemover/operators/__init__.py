"""DataFrame operators: selection, sequence numbers, estimate, copy, reconcile, rewrite."""
