"""Where rows come from and go to: scans, extract parts, versioned tables."""
