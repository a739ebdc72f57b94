"""DataFrame operators. None collects data on the driver; each states what it shuffles."""
