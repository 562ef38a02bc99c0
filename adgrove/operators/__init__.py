"""DataFrame operators: ad totals, roll-ups, pairs, components, clustering, text statistics."""
