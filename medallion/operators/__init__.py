"""DataFrame -> DataFrame operators; none of them touches storage."""
