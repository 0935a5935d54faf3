"""DataFrame -> DataFrame verbs."""
