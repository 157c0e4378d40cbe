"""DataFrame -> DataFrame operators shared by the batch and the streaming jobs."""
