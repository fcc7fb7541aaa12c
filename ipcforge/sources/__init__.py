"""Sources: file listings, bulletin archives, suggestion files, derived inputs."""
