"""Where rows come from: the given tables as domain tables, HTML and JSON readers, landing folders."""
