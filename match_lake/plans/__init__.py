"""The operators put together: one function per scheduled job."""
