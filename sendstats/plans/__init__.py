"""The four end-to-end reports and the runner that picks one."""
