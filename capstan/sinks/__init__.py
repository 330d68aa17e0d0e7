"""Writers: content-addressed folders, listings and result rows."""
