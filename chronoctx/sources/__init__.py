"""Sources: notification readers, stored history and the table adapters."""
