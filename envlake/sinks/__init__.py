"""Writers: versioned snapshots, text export, batch registry."""
