"""Where rows come from: archives, documents, file listings and stored tables."""
