"""DataFrame-to-DataFrame operators; none of them triggers an action unless its text says so."""
